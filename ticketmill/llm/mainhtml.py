"""Main text of HTML pages by minimum-cut labelling of their blocks.

A page is cut into text blocks at block-level tags. A small linear classifier turns what is known of a block (the elements it
stands in, words of their class, id and role, share of link text, length, punctuation) into log odds of being content; these
are the capacities from the source (content) and to the sink (boilerplate). Neighbouring blocks are tied by an edge that is
stronger the closer they are in the element tree: the same parent, the same section, else weak. The minimum cut
gives the labelling with the least cost of blocks and of neighbours that are torn apart, so a short heading goes with its text
and a lone sentence in a menu with the menu. It is found by augmenting shortest paths.

Scripts, styles, templates, comments, controls, embedded media and the head are never text. Elements that are not the article by their tag
(nav, footer, form and the like) or are hidden keep their blocks out at any length: such a block has no cost on the other side. Words of
class and id and roles only add to the odds, less so inside an article, where a section may well be called ``discussion``. The weights
are set by hand, not fitted. An element of a kind that is skipped is skipped only if its end tag comes before the next one of its kind begins,
so that an unclosed one loses no text. Time and memory grow with the length of the page, at any depth.

Null and empty pages have an empty text. Broken markup is read as browsers do in the main: unknown and unclosed tags are tolerated,
and a paragraph ends where the next block begins. Character references are decoded once. White space inside a block becomes
one space; blocks are joined by a line break in page order. Rows repeat as they come in.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML standard, by use.
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# text up to the end tag, or to the end of the page
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
# controls, media and what is not shown: skipped up to their end tag
SKIPPED = {"noscript", "template", "svg", "object", "canvas", "audio", "video", "button", "label"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# an open element of the first kind ends before a tag of the second
CLOSED_BY = {
    "p": BLOCKS - {"body", "html"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "thead", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "thead", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "thead", "tfoot"},
    "option": {"option", "optgroup"},
}

# Elements, roles and words of class or id that mark what is not the article, and what is.
OUT_TAGS = {"nav", "footer", "aside", "form", "select", "dialog", "menu", "fieldset", "search"}
OUT_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
OUT_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising advertorial adbox adslot adunit banner sponsor sponsored promo promotion"
    " nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer foot bottom sidebar side rail aside widget widgets"
    " related recommended recommendations more popular trending cookie cookies consent gdpr notice notices notification alert popup modal overlay"
    " newsletter subscribe subscription signup login share sharing social follow comment comments commentlist disqus respond replies reply"
    " discussion feedback form search pagination pager tags taglist copyright legal disclaimer skip toolbar".split()
)
# words that name a part of an article as well, so they count only outside of one
MILD_WORDS = set(
    "header banner more side bottom foot legal tags alert notice notices form search discussion feedback related recommended recommendations"
    " popular trending disclaimer copyright follow".split()
)
COMMENT_WORDS = {"comment", "comments", "commentlist", "disqus", "reply", "replies"}
# what a word or role takes from the log odds, and what a mild word does inside an article
MARKED, MILDLY = 6.0, 2.0
IN_TAGS = {"article": 2.5, "main": 2.0, "section": 0.2}
IN_WORDS = set("article content main post entry story text body prose maincontent articlebody postcontent entrycontent blogpost".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|([^<]+|<)", re.S)
MARKS = re.compile(r"\b(class|id|role|hidden|aria-hidden|style|itemprop)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

CERTAIN = 1e6


class Element:
    __slots__ = ("tag", "parent", "depth", "score", "out", "article", "number")

    def __init__(self, tag: str, parent: Element | None, marks: str, number: int):
        self.tag, self.parent, self.number = tag, parent, number
        self.depth = parent.depth + 1 if parent else 0
        self.score, self.out, self.article = (parent.score, parent.out, parent.article) if parent else (0.0, False, False)
        if not (self.article and tag in ("article", "main")):
            self.score += IN_TAGS.get(tag, 0.0)
        words: set[str] = set()
        if marks:
            for m in MARKS.finditer(marks):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name in ("class", "id", "itemprop"):
                    words.update(WORD.findall(CAMEL.sub(" ", value).lower()))
                elif name == "role":
                    if value.lower() in OUT_ROLES:
                        self.score -= MARKED
                    elif value.lower() in ("main", "article"):
                        self.score += 2.0
                elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                    self.out = True
                elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    self.out = True
        if tag in OUT_TAGS or (tag == "header" and not self.article):
            self.out = True
        if tag in ("article", "main"):
            if words & COMMENT_WORDS:
                self.score -= MARKED
        elif words and tag not in ("html", "body"):
            against = words & OUT_WORDS
            if against and not (words & IN_WORDS and tag in HEADINGS):
                self.score -= MILDLY if self.article and against <= MILD_WORDS else MARKED
            elif words & IN_WORDS:
                self.score += 1.5
        self.article = self.article or tag in ("article", "main")


class Ahead:
    """The next place of a pattern at or after ones that only grow: the page is searched once for each pattern."""

    def __init__(self, page: str):
        self.page = page
        self.found: dict[str, tuple[int, int]] = {}

    def next(self, pattern: str, at: int) -> tuple[int, int]:
        """Start and end of the next match, (-1, -1) if there is none."""
        known = self.found.get(pattern)
        if known is None or 0 <= known[0] < at:
            m = re.compile(pattern, re.I).search(self.page, at)
            known = self.found[pattern] = m.span() if m else (-1, -1)
        return known


class Block:
    __slots__ = ("element", "text", "linked", "tag")

    def __init__(self, element: Element, text: str, linked: int):
        self.element, self.text, self.linked = element, text, linked
        self.tag = element.tag


def blocks_of(page: str) -> list[Block]:
    """Text blocks of a page in their order, with the element each stands in."""
    blocks: list[Block] = []
    number = 0
    top = Element("", None, "", 0)
    stack, parts, linked, links = [top], [], 0, 0
    block_at = top  # the innermost block-level element

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                blocks.append(Block(block_at, text, linked))
            parts, linked = [], 0

    at, size = 0, len(page)
    ahead = Ahead(page)
    open_tags: Counter[str] = Counter()

    def close(down_to: int):
        nonlocal block_at
        open_tags.subtract([e.tag for e in stack[down_to:]])
        del stack[down_to:]
        block_at = stack[-1]

    while at < size:
        m = TOKEN.match(page, at)
        at = m.end()
        if m[4] is not None:
            parts.append(m[4])
            if links:
                linked += len(m[4])
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:  # an end tag
            if tag == "a":
                links = max(0, links - 1)
            if tag == "head" and open_tags["head"]:
                parts, linked = [], 0
                close(max(k for k, e in enumerate(stack) if e.tag == "head"))
            if tag not in BLOCKS:
                continue
            flush()
            if open_tags[tag]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        close(k)
                        break
                    # a section is not closed by a tag of something smaller inside it
                    if tag in ("p", "li") and stack[k].tag in ("article", "section", "div", "body", "main", "td", "ul", "ol"):
                        break
            links = 0 if tag not in ("li", "p") else links
            continue
        if tag in RAW:
            end = ahead.next(f"</{tag}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", at)[1]
            at = size if end < 0 else end
            continue
        if tag in SKIPPED:
            if m[3].endswith("/") and tag == "svg":
                continue
            start, end = ahead.next(f"</{tag}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", at)
            another = ahead.next(f"<{tag}(?=[\\s/>])", at)[0]
            if start >= 0 and not 0 <= another < start:
                at = end
            continue
        if tag == "br" or tag == "wbr":
            parts.append(" " if tag == "br" else "")
            continue
        if tag == "a":
            links = 1
            continue
        if tag != "head" and (tag not in BLOCKS or tag in VOID):
            if tag == "hr":
                flush()
            continue
        flush()
        if tag == "body":
            while len(stack) > 1 and stack[-1].tag == "head":
                close(len(stack) - 1)
        while len(stack) > 1 and tag in CLOSED_BY.get(stack[-1].tag, ()):
            close(len(stack) - 1)
        number += 1
        stack.append(Element(tag, stack[-1], "" if tag == "head" else m[3], number))
        open_tags[tag] += 1
        block_at = stack[-1]
        if tag == "head":
            block_at.out = True
        else:
            links = 0
    flush()
    return blocks


def log_odds(block: Block, has_article: bool) -> float:
    """Log odds of being content; -CERTAIN for what is not by its tag."""
    e = block.element
    if e.out:
        return -CERTAIN
    words = block.text.count(" ") + 1
    share = min(1.0, block.linked / max(len(block.text), 1))
    score = e.score - 3.0 * share + min(words, 40) / 20
    score += 0.8 if e.tag == "p" else 1.0 if e.tag in HEADINGS else 0.3 if e.tag in ("li", "td", "dd", "dt", "blockquote", "pre", "figcaption") else 0.0
    score += 0.5 if block.text[-1] in ".!?:”\"…" else 0.0
    return score - (3.5 if has_article and not e.article else 1.0)


def common_depth(a: Element, b: Element) -> int:
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return a.depth


def ties(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours in page order by their distance in the tree, and each block to the last of the same parent."""
    out = []
    latest: dict[int, int] = {}
    for i, b in enumerate(blocks):
        holder = b.element.parent or b.element
        if i:
            shared = common_depth(blocks[i - 1].element, b.element)
            apart = blocks[i - 1].element.depth + b.element.depth - 2 * shared
            out.append((i - 1, i, 1.2 / (1 + max(apart - 1, 0))))
        before = latest.get(id(holder))
        if before is not None and before != i - 1:
            out.append((before, i, 0.4))
        latest[id(holder)] = i
    return out


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut, the smallest such side.

    A node with positive odds has that capacity from the source, others to the sink. Breadth-first search finds a shortest
    path with room until none is left.
    """
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    of: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a: int, b: int, there: float, back: float) -> None:
        of[a].append(len(to))
        to.append(b)
        room.append(there)
        of[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, x in enumerate(odds):
        if x > 0:
            edge(source, i, x, 0.0)
        elif x < 0:
            edge(i, sink, -x, 0.0)
    for a, b, w in edges:
        edge(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in of[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        # all shortest paths of this level, by depth-first search with the edges already tried left out
        tried = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                a = to[path[first] ^ 1]
                del path[first:]
                continue
            while tried[a] < len(of[a]):
                e = of[a][tried[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    break
                tried[a] += 1
            else:
                if a == source:
                    break
                tried_from = path.pop()
                a = to[tried_from ^ 1]
                tried[a] += 1
                continue
            path.append(e)
            a = to[e]


def labelled(page: str) -> tuple[list[Block], list[float], list[bool]]:
    """Blocks of a page, their odds, and whether the cut keeps them."""
    blocks = blocks_of(page)
    has_article = any(b.element.article and not b.element.out for b in blocks)
    odds = [log_odds(b, has_article) for b in blocks]
    return blocks, odds, minimum_cut(odds, ties(blocks)) if blocks else []


def main_text(page: str) -> str:
    blocks, _, kept = labelled(page)
    return "\n".join([b.text for b, k in zip(blocks, kept) if k])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", counts: bool = False) -> DataFrame:
    """One row per page: the id, the url, text (string) and n_chars (long, its code points).

    With ``counts`` also n_blocks and n_turned: the page's blocks, and those that the cut labels against their own odds.
    """

    def run(batches):
        for batch in batches:
            texts, blocks, turned = [], [], []
            for t in batch.column("html"):
                found, odds, kept = labelled(t.as_py() or "")
                texts.append("\n".join([b.text for b, k in zip(found, kept) if k]))
                blocks.append(len(found))
                turned.append(sum(k != (x > 0) for x, k in zip(odds, kept)))
            whole = [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            if counts:
                whole += [pa.array(blocks, pa.int64()), pa.array(turned, pa.int64())]
            yield pa.RecordBatch.from_arrays(whole, names=names)

    names = [id_col, url_col, "text", "n_chars"] + (["n_blocks", "n_turned"] if counts else [])
    picked = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    more = ", n_blocks long, n_turned long" if counts else ""
    return picked.mapInArrow(run, f"`{id_col}` {dict(picked.dtypes)['id']}, `{url_col}` string, text string, n_chars long{more}")


def article_sql() -> str:
    """What the pages of the supplied tables hold, said plainly in DuckDB's SQL: the headings and paragraphs of the article."""
    refs = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "\'\'", "&nbsp;": " ", "&copy;": "©", "&middot;": "·"}
    inner = "regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)</article>', 1), '</?(p|h1)>', chr(1), 'g'), '<[^>]*>', ' ', 'g')"
    for ref, plain in refs.items():
        inner = f"replace({inner}, '{ref}', '{plain}')"
    inner = f"regexp_replace({inner}, '&amp;?', '&', 'g')"  # the standard allows it without a semicolon
    tidy = "trim(regexp_replace(x, '\\s+', ' ', 'g'))"
    return f"""WITH t AS (SELECT page_id, url, coalesce(list_aggregate(list_filter([{tidy} for x in string_split({inner}, chr(1))], lambda x: x <> ''), 'string_agg', chr(10)), '') AS "text" FROM pages)
      SELECT page_id, url, "text", length("text")::BIGINT AS n_chars FROM t"""
