"""Licence recognition by sentence rules, with DataFrame functions only.

Text is cut into sentences, each sentence is normalised and mapped to the id of a known licence sentence, and the
sequence of ids is matched against rules in their order. A rule is a sequence of sentence ids that must appear in
this order; other licence sentences may stand between them. A match uses up its sentences, so a shorter rule
further down does not fire on them again.

Everything happens inside the row: no shuffle, no join, nothing that grows with the data.

Null and empty texts give no rows; a null id is passed through; repeated rows give repeated results; other columns
of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised licence sentences (public licence texts and usual notices) by id.
SENTENCES = {
    1: "released under the mit license",
    2: "licensed under the apache license version 2 0",
    3: "licensed under cc by nc 4 0",
    4: "this work is licensed under the gnu general public license version 3",
    5: "licensed under the mit license",
    6: "this project is licensed under the mit license",
    7: "this work is licensed under a creative commons attribution 4 0 international license",
    8: "licensed under cc by 4 0",
    10: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction including without limitation the"
    " rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit"
    " persons to whom the software is furnished to do so subject to the following conditions",
    11: "the above copyright notice and this permission notice shall be included in all copies or substantial"
    " portions of the software",
    12: "the software is provided as is without warranty of any kind express or implied including but not limited to"
    " the warranties of merchantability fitness for a particular purpose and noninfringement",
    20: "licensed under the apache license version 2 0 the license",
    21: "you may not use this file except in compliance with the license",
    22: "you may obtain a copy of the license at http www apache org licenses license 2 0",
    30: "redistributions of source code must retain the above copyright notice this list of conditions and the"
    " following disclaimer",
    31: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the"
    " following disclaimer in the documentation and or other materials provided with the distribution",
    32: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission",
    40: "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
    " public license as published by the free software foundation either version 3 of the license or at your option"
    " any later version",
    13: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction including without limitation the"
    " rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit"
    " persons to whom the software is furnished to do so",
    33: "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    41: "you can redistribute it and or modify it under the terms of the gnu general public license as published by the"
    " free software foundation either version 3 of the license or at your option any later version",
    42: "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
    " public license as published by the free software foundation either version 2 of the license or at your option"
    " any later version",
    43: "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
    " public license version 2 as published by the free software foundation",
    44: "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published"
    " by the free software foundation either version 3 of the license or at your option any later version",
    45: "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser"
    " general public license as published by the free software foundation either version 2 1 of the license or at your"
    " option any later version",
    46: "you can redistribute it and or modify it under the terms of the gnu affero general public license as published"
    " by the free software foundation either version 3 of the license or at your option any later version",
    50: "this source code form is subject to the terms of the mozilla public license v",  # "v. 2.0" ends a sentence
    51: "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"
    " which is available at https www eclipse org legal epl 2 0",
    60: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
    " granted provided that the above copyright notice and this permission notice appear in all copies",
    61: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
    " granted",
    62: "the software is provided as is and the author disclaims all warranties with regard to this software including"
    " all implied warranties of merchantability and fitness",
    65: "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and"
    " accompanying documentation covered by this license the software to use reproduce display distribute execute and"
    " transmit the software and to prepare derivative works of the software and to permit third parties to whom the"
    " software is furnished to do so all subject to the following",
    70: "this is free and unencumbered software released into the public domain",
    71: "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or"
    " as a compiled binary for any purpose commercial or non commercial and by any means",
    72: "this software is provided as is without any express or implied warranty",
    73: "in no event will the authors be held liable for any damages arising from the use of this software",
    74: "permission is granted to anyone to use this software for any purpose including commercial applications and to"
    " alter it and redistribute it freely subject to the following restrictions",
    80: "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    81: "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    82: "this work is licensed under a creative commons attribution noderivatives 4 0 international license",
    83: "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license",
    84: "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license",
    85: "licensed under cc0 1 0",
    90: "licensed under the bsd 2 clause license",
    91: "licensed under the bsd 3 clause license",
    92: "licensed under the isc license",
    93: "licensed under the gnu general public license version 2",
    94: "licensed under the gnu lesser general public license version 2 1",
    95: "licensed under the gnu lesser general public license version 3",
    96: "licensed under the gnu affero general public license version 3",
    97: "licensed under the mozilla public license version 2 0",
    98: "licensed under the boost software license version 1 0",
    99: "licensed under the eclipse public license version 2 0",
}

# Other spellings of a known sentence.
SPELLINGS = {
    "licensed under cc by sa 4 0": 80,
    "licensed under cc by nd 4 0": 82,
    "licensed under cc by nc sa 4 0": 83,
    "licensed under cc by nc nd 4 0": 84,
    "licensed under the simplified bsd license": 90,
    "licensed under the new bsd license": 91,
    "licensed under the gnu gpl version 2": 93,
    "licensed under the gnu lgpl version 2 1": 94,
    "licensed under the gnu lgpl version 3": 95,
    "licensed under the gnu agpl version 3": 96,
    "licensed under the mpl 2 0": 97,
    "licensed under the epl 2 0": 99,
    "this work is licensed under a creative commons attribution share alike 4 0 international license": 80,
    "this work is licensed under a creative commons attribution non commercial 4 0 international license": 81,
    "this work is licensed under a creative commons attribution no derivatives 4 0 international license": 82,
}

# Rules in order of precedence, (rule, licence, sentence ids in order).
RULES = [
    ("mit_text", "MIT", [10, 11, 12]),
    ("mit_0_text", "MIT-0", [13, 12]),
    ("bsd_4_text", "BSD-4-Clause", [30, 31, 33, 32]),
    ("bsd_3_text", "BSD-3-Clause", [30, 31, 32]),
    ("bsd_2_text", "BSD-2-Clause", [30, 31]),
    ("apache_2_header", "Apache-2.0", [20, 21, 22]),
    ("gpl_3_header", "GPL-3.0-or-later", [40]),
    ("gpl_3_header_colon", "GPL-3.0-or-later", [41]),
    ("gpl_2_header", "GPL-2.0-or-later", [42]),
    ("gpl_2_only_header", "GPL-2.0-only", [43]),
    ("lgpl_3_header", "LGPL-3.0-or-later", [44]),
    ("lgpl_2_1_header", "LGPL-2.1-or-later", [45]),
    ("agpl_3_header", "AGPL-3.0-or-later", [46]),
    ("mpl_2_header", "MPL-2.0", [50]),
    ("epl_2_header", "EPL-2.0", [51]),
    ("isc_text", "ISC", [60, 62]),
    ("zero_bsd_text", "0BSD", [61, 62]),
    ("boost_1_text", "BSL-1.0", [65]),
    ("unlicense_text", "Unlicense", [70, 71]),
    ("zlib_text", "Zlib", [72, 73, 74]),
    ("mit_released", "MIT", [1]),
    ("mit_licensed", "MIT", [5]),
    ("mit_project", "MIT", [6]),
    ("apache_2_notice", "Apache-2.0", [2]),
    ("gpl_3_notice", "GPL-3.0-only", [4]),
    ("cc_by_nc_4_notice", "CC-BY-NC-4.0", [3]),
    ("cc_by_4_notice", "CC-BY-4.0", [8]),
    ("cc_by_4_work", "CC-BY-4.0", [7]),
    ("cc_by_sa_4_notice", "CC-BY-SA-4.0", [80]),
    ("cc_by_nc_4_work", "CC-BY-NC-4.0", [81]),
    ("cc_by_nd_4_notice", "CC-BY-ND-4.0", [82]),
    ("cc_by_nc_sa_4_notice", "CC-BY-NC-SA-4.0", [83]),
    ("cc_by_nc_nd_4_notice", "CC-BY-NC-ND-4.0", [84]),
    ("cc0_1_notice", "CC0-1.0", [85]),
    ("bsd_2_notice", "BSD-2-Clause", [90]),
    ("bsd_3_notice", "BSD-3-Clause", [91]),
    ("isc_notice", "ISC", [92]),
    ("gpl_2_notice", "GPL-2.0-only", [93]),
    ("lgpl_2_1_notice", "LGPL-2.1-only", [94]),
    ("lgpl_3_notice", "LGPL-3.0-only", [95]),
    ("agpl_3_notice", "AGPL-3.0-only", [96]),
    ("mpl_2_notice", "MPL-2.0", [97]),
    ("boost_1_notice", "BSL-1.0", [98]),
    ("epl_2_notice", "EPL-2.0", [99]),
]

# every sentence contains one of these words, so a text without them needs no splitting
ANCHORS = ["licen", "software", "redistribut"]

BLANK = " \\t\\r\\n\\f"


def anchored(text: Column) -> Column:
    """Whether a text can contain a known sentence at all."""
    return text.rlike("(?i)" + "|".join(ANCHORS))


def sentences_of(text: Column) -> Column:
    """Sentences end at a line break, or at . ! ? followed by white space."""
    return F.split(F.regexp_replace(text, f"([.!?:])[{BLANK}]+", "$1\n"), "\n")


def normalised(sentence: Column) -> Column:
    """Lower-case ASCII letters and digits, other characters as single spaces; "licence" is written "license"."""
    return F.replace(F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " ")), F.lit("licence"), F.lit("license"))


def spelled(sentences: dict[int, str]) -> list[tuple[str, str]]:
    """Every spelling of the sentences with the mark of its sentence."""
    return [(s, f"<{i}>") for i, s in sentences.items()] + [(s, f"<{i}>") for s, i in SPELLINGS.items() if i in sentences]


def sentence_ids(text: Column, sentences: dict[int, str]) -> Column:
    """Ids of the known sentences of a text in their order, as <id><id>..."""
    known = F.create_map(*[F.lit(x) for pair in spelled(sentences) for x in pair])
    found = F.transform(sentences_of(text), lambda s: F.element_at(known, normalised(s)))
    return F.array_join(found, "")  # leaves out nulls


def rule_pattern(ids: list[int]) -> tuple[str, str]:
    """The rule as a pattern, and what stays of the text it matches: the other ids in between."""
    between = "((?:<[0-9]+>)*?)"
    kept = "".join(f"${k}" for k in range(1, len(ids)))
    return between.join(f"<{i}>" for i in ids), kept


def licence_matches(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sentences: dict[int, str] = SENTENCES,
    rules: list[tuple[str, str, list[int]]] = RULES,
) -> DataFrame:
    """One row per document and rule that matches: the id, rule, licence, matches (long) and sentence_ids of the document."""
    held = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(anchored(F.col("text")))
    df = held.select("id", sentence_ids(F.col("text"), sentences).alias("ids")).where(F.col("ids") != "")
    df = df.withColumn("rest", F.col("ids"))
    for k, (_, _, ids) in enumerate(rules):
        pattern, kept = rule_pattern(ids)
        df = df.select(
            "*",
            F.regexp_count("rest", F.lit(pattern)).cast("long").alias(f"n{k}"),
        ).withColumn("rest", F.regexp_replace("rest", pattern, kept))
    found = [
        F.when(F.col(f"n{k}") > 0, F.struct(F.lit(r).alias("rule"), F.lit(x).alias("licence"), F.col(f"n{k}").alias("matches")))
        for k, (r, x, _) in enumerate(rules)
    ]
    hits = df.select("id", "ids", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("m"))
    return hits.select(F.col("id").alias(id_col), "m.rule", "m.licence", "m.matches", F.col("ids").alias("sentence_ids"))


def licence_sql(sentences: dict[int, str] = SENTENCES, rules=RULES) -> str:
    """The same in DuckDB's SQL."""
    known = ", ".join(f"('{s}', '{mark}')" for s, mark in spelled(sentences))
    rests, now = [], "ids"
    for k, (_, _, ids) in enumerate(rules):
        pattern, kept = rule_pattern(ids)
        kept = kept.replace("$", "\\")
        rests.append(f"r{k} AS (SELECT *, len(regexp_extract_all({now}, '{pattern}')) AS n{k}, regexp_replace({now}, '{pattern}', '{kept}', 'g') AS rest{k} FROM {f'r{k - 1}' if k else 'docs'})")
        now = f"rest{k}"
    last = f"r{len(rules) - 1}"
    rows = " UNION ALL ".join(
        f"SELECT doc_id, '{r}' AS rule, '{x}' AS licence, n{k} AS matches, ids AS sentence_ids FROM {last} WHERE n{k} > 0"
        for k, (r, x, _) in enumerate(rules)
    )
    return f"""WITH known(sentence, mark) AS (VALUES {known}),
      parts AS (SELECT doc_id, unnest(p) AS part, generate_subscripts(p, 1) AS pos FROM
        (SELECT doc_id, string_split(regexp_replace(text, '([.!?:])[ \\t\\r\\n\\f]+', '\\1' || chr(10), 'g'), chr(10)) AS p FROM documents)),
      marks AS (SELECT doc_id, pos, mark FROM parts JOIN known ON sentence = replace(trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')), 'licence', 'license')),
      docs AS (SELECT doc_id, string_agg(mark, '' ORDER BY pos) AS ids FROM marks GROUP BY doc_id),
      {", ".join(rests)}
      {rows}"""


__all__ = ["RULES", "SENTENCES", "licence_matches", "licence_sql"]
