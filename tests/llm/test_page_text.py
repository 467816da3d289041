"""Main text of pages with stray elements, words that only hint, hostile markup, and blocks that the cut turns."""

import time

import pytest

from ticketmill.llm import mainhtml

FIRST = "First paragraph has a good number of words in it."
SECOND = "Second paragraph has a good number of words too."


@pytest.mark.parametrize(
    "stray",
    ["<label>Name</label>", "<label>", "<button>Share</button>", "<button>", "<video src=x>", "<video>none</video>", "<object>", "<canvas>", "<noscript>",
     "<template><p>t</p></template>", "<svg/>", "<svg><text>x</text></svg>", "</section>", "</label>", "<iframe></iframe>", "<!-- <p>x</p> -->"],
)
def test_stray_elements_lose_no_text(stray):
    page = f"<head><title>q</title></head><body><nav><a href=x>Home</a></nav><article><h1>T</h1><p>{FIRST}</p>{stray}<p>{SECOND}</p></article><footer>c</footer>"
    assert mainhtml.main_text(page) == f"T\n{FIRST}\n{SECOND}"


def test_text_of_formulas_stays():
    assert mainhtml.main_text("<article><p>The sum <math><mi>x</mi></math> is the result of all of this.</p></article>") == "The sum x is the result of all of this."


@pytest.mark.parametrize("mark", ['id="discussion"', 'class="related-work"', 'class="feedback"', 'class="legal"'])
def test_sections_of_an_article_may_have_any_name(mark):
    assert mainhtml.main_text(f"<article><p>{FIRST}</p><section {mark}><p>{SECOND}</p></section></article>") == f"{FIRST}\n{SECOND}"


@pytest.mark.parametrize(
    "out",
    [f'<div class="comments"><p>{SECOND}</p></div>', f'<article class="comment"><p>{SECOND}</p></article>', f'<div class="ad"><p>{SECOND}</p></div>',
     f"<aside><p>{SECOND}</p></aside>", f"<form><p>{SECOND}</p></form>", f"<div hidden><p>{SECOND}</p></div>", f'<div role="navigation"><p>{SECOND}</p></div>',
     '<div class="related"><a href=x>Some other page</a></div>'],
)
def test_what_is_not_the_article_goes(out):
    assert mainhtml.main_text(f"<article><p>{FIRST}</p>{out}<p>{FIRST}</p></article>") == f"{FIRST}\n{FIRST}"


def test_the_cut_turns_blocks_against_their_odds(spark):
    inside = f"<div><p>{FIRST}</p><div>More</div><p>{SECOND}</p></div>"
    menu = "<ul>" + "<li><a href=x>Link</a></li>" * 3 + "<li>A sentence stands in this menu of short links.</li>" + "<li><a href=x>Link</a></li>" * 3 + "</ul>"
    blocks, odds, kept = mainhtml.labelled(inside)
    assert odds[1] < 0 and kept == [True] * 3
    blocks, odds, kept = mainhtml.labelled(menu)
    assert odds[3] > 0 and not any(kept)
    df = spark.createDataFrame([(1, "u", inside), (2, "u", menu), (3, "u", None)], "page_id long, url string, html string")
    got = {r.page_id: (r.n_blocks, r.n_turned) for r in mainhtml.extract(df, counts=True).collect()}
    assert got == {1: (3, 1), 2: (7, 1), 3: (0, 0)}


@pytest.mark.parametrize("page", ["<div>" * 20000 + "</section>" * 20000, "<section>" + "<div>" * 20000 + "</td>" * 20000, "<label>" * 30000, "<video>x" * 30000,
                                  "<div>x" * 20000, "<button>a</button>" * 20000])
def test_time_grows_with_the_length(page):
    start = time.process_time()
    mainhtml.main_text(page)
    assert time.process_time() - start < 5
