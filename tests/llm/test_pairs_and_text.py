"""Jaccard join, decontamination, toxicity and licences against brute force and on edge rows."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from ticketmill.llm import decontaminate, hashing, jaccard, licences, toxicity
from ticketmill.llm.components import components

DOCS = "doc_id long, text string, n_shingles int, component_id string, toxic boolean"


def docs_of(spark, rows):
    """Rows (id, text) as a table with columns whose names clash with results."""
    return spark.createDataFrame([(i, t, 7, "x", True) for i, t in rows], DOCS)


def brute_groups(rows, k, num, den):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[p : p + k]) for p in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and both * den >= num * len(sets[a] | sets[b]) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def near_texts(seed, n):
    r = random.Random(seed)
    words = [f"w{x}" for x in range(60)]
    base = [r.choice(words) for _ in range(40)]
    out = []
    for i in range(n):
        kind = r.randrange(4)
        w = list(base) if kind else [r.choice(words) for _ in range(r.randrange(0, 50))]
        for _ in range(kind - 1):
            w[r.randrange(len(w))] = r.choice(words)
        if r.random() < 0.2:
            w += w[:5]
        out.append((i, " ".join(w) if r.random() < 0.9 else " ".join(w).upper() + "\n"))
    return out


@pytest.mark.parametrize(("k", "num", "den"), [(4, 85, 100), (5, 4, 5), (2, 1, 2)])
def test_groups_equal_brute_force(spark, ws, monkeypatch, k, num, den):
    monkeypatch.setattr(jaccard, "GROUP_DOCS", 3)  # several chunks, so leaders and pairs of groups are used
    rows = [*near_texts(k, 60), (100, None), (101, ""), (102, " \n"), (103, "one"), (104, "One"), (105, "one two")]
    got = jaccard.linked_groups(ws, docs_of(spark, rows), k, num, den)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == brute_groups(rows, k, num, den)


def test_groups_of_no_rows_null_and_repeated_ids(spark, ws):
    assert jaccard.linked_groups(ws, docs_of(spark, []), 4, 85, 100).count() == 0
    got = jaccard.linked_groups(ws, docs_of(spark, [(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (2, "A b c d e")]), 4, 85, 100)
    assert sorted(map(tuple, got.collect())) == [(2, 2, 2), (3, 2, 2), (3, 2, 2)]


def test_components_of_chains_and_stars(spark, ws):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 120)] + [(5, 5), (None, 1), (200, 201), (201, 200)]
    got = {r[0]: r[1] for r in components(ws, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 120)}, 200: 200, 201: 200}
    assert components(ws, spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_follow_the_words():
    texts = ["a b  c", None, "", "A\tb\nc\x0b", "é É", "x" * 3_000_000 + " a"]
    hashes, at = hashing.words(pa.array(texts))
    rows = [hashes[s:e].tolist() for s, e in zip(at[:-1], at[1:])]
    assert [len(r) for r in rows] == [3, 0, 0, 3, 2, 2]
    assert rows[0] == rows[3] and rows[4][0] != rows[4][1] and rows[5][1] == rows[0][0]
    assert hashing.words(pa.array(texts).slice(3, 1))[0].tolist() == rows[3]


ITEM = "We know that Anna walked with Bob for 5 km to the old market and paid 30 dollars to Bob for bread."


def test_leaks(spark):
    items = spark.createDataFrame([(7, ITEM, 1), (8, "", 1), (9, None, 1), (None, ITEM, 1), (10, "too short to match", 1), (7, ITEM, 1)], "item_id long, text string, doc_id int")
    other = ITEM.replace("Anna", "Carl").replace("Bob", "Dora").replace("5 km", "7 miles").replace("30", "90")
    texts = [
        (1, "Once upon a time. " + ITEM + " The end"),
        (2, "Well then. " + other),
        (3, other.replace("paid 90 dollars to Dora", "paid 90 dollars to Emil")),  # Bob is two people here
        (4, None),
        (5, ""),
        (6, "We know that Anna walked with nobody at all, and the rest of this text is about other things."),
        (1, "Once upon a time. " + ITEM + " The end"),
        (None, ITEM),
    ]
    got = decontaminate.leaks(docs_of(spark, texts), items).collect()
    assert {(r.doc_id, r.item_id): r.kind for r in got} == {(1, 7): "verbatim", (2, 7): "reparameterised"}
    assert len(got) == 2 and all(0.5 <= r.coverage <= 1 for r in got)
    assert decontaminate.leaks(docs_of(spark, []), items).count() == 0
    assert decontaminate.leaks(docs_of(spark, texts), items.where("item_id = 8")).count() == 0


def test_template_kinds():
    _, _, kind, at, _ = decontaminate.template(pa.array(["Then Anna paid 3.50 dollars. Bob ate 7 kg, Étienne too", "kg 5"]))
    assert at.tolist() == [0, 11, 13]
    assert kind[:11].tolist() == [0, 3, 0, 1, 2, 0, 0, 1, 2, 3, 0] and kind[11:].tolist() == [0, 1]


def toxic_corpus(n):
    r = random.Random(3)
    words = [f"plain{x}" for x in range(200)]
    rows, labels = [], []
    for i in range(n):
        w = [r.choice(words) for _ in range(r.randrange(5, 60))]
        bad = i % 5 == 0
        for _ in range(r.randrange(2, 6) if bad else 0):
            w[r.randrange(len(w))] = r.choice(["vileword", "nastybit", "lowei" + r.choice("abcd")])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_corpus(600)
    docs = docs_of(spark, [*rows, (1000, None), (1001, ""), (None, "vileword"), (0, rows[0][1])])
    known = spark.createDataFrame([*[x for x in labels if x[0] % 2], (None, 1, 1), (3, None, None), *[x for x in labels[:100]]], "doc_id long, quality int, toxic int")
    model = toxicity.train(spark, docs, known)
    got = toxicity.score(docs, model)
    assert got.columns == ["doc_id", "severity", "grade", "toxic"]
    rows_out = [r for r in got.collect() if r.doc_id is not None and 100 <= r.doc_id < 600 and r.doc_id % 2 == 0]
    right = sum(r.toxic == (r.doc_id % 5 == 0) for r in rows_out)
    assert len(rows_out) == 250 and right >= 245
    assert got.count() == 604 and not got.where("doc_id >= 1000").where("toxic").count()
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == got.where("not toxic").count()


def ordinal_loss(theta, x, grade, top):
    """The penalised likelihood, row by row as the model states it."""
    width = x.shape[1]
    w, cuts = theta[:width], theta[width:]
    total = 0.5 * toxicity.RIDGE * float(w @ w)
    for row, g in zip(x, grade):
        over = [1.0] + [1.0 / (1.0 + np.exp(-(row @ w - c))) for c in cuts] + [0.0]
        total -= np.log(over[g] - over[g + 1])
    return total / len(x) if (np.diff(cuts) > 0).all() else np.inf


def test_ordinal_fit_against_a_plain_optimiser():
    """Ten features, four grades: the gradient vanishes at the fit, and steps down a numeric gradient from elsewhere end at it."""
    r = np.random.default_rng(3)
    x = r.poisson(0.7, (150, 10)).astype(float)
    eta = x @ r.normal(0, 1, 10) + r.logistic(size=150)
    grade = np.searchsorted(np.quantile(eta, [0.4, 0.6, 0.8]), eta)
    row, col = np.nonzero(x)
    w, cuts = toxicity.fit_ordinal(row, col, x[row, col], grade, 10)
    fitted = np.r_[w, cuts]

    def gradient(theta):
        step = 1e-5 * np.eye(len(theta))
        return np.array([(ordinal_loss(theta + s, x, grade, 3) - ordinal_loss(theta - s, x, grade, 3)) / 2e-5 for s in step])

    assert (np.diff(cuts) > 0).all() and np.abs(gradient(fitted)).max() < 1e-6
    theta = np.r_[np.zeros(10), -1.0, 0.0, 1.0]
    for _ in range(12):  # Newton's method with numeric derivatives, the step halved where it overshoots
        g, now = gradient(theta), ordinal_loss(theta, x, grade, 3)
        curve = np.array([(gradient(theta + s) - g) / 1e-4 for s in 1e-4 * np.eye(len(theta))])
        step = np.linalg.solve((curve + curve.T) / 2, g)
        while ordinal_loss(theta - step, x, grade, 3) > now + 1e-12 and np.abs(step).max() > 1e-6:
            step /= 2
        theta = theta - step
    assert np.abs(theta - fitted).max() < 1e-3


def test_severity_row_by_row():
    texts = ["bad bad worse", "", None, "Worsening BAD, badly!", "nothing here", "bad " * 500]
    hashes, _ = toxicity.text_features(pa.array(["bad worse badly"]))
    features = np.unique(hashes)
    weights, cuts = np.linspace(0.2, 1.1, len(features)), np.array([0.5, 1.5, 2.5])
    s, g, t = toxicity.severity(pa.array(texts), features, weights, cuts)
    for k, text in enumerate(texts):
        found, _ = toxicity.text_features(pa.array([text], pa.string()))
        eta = sum(w * np.log1p(int((found == f).sum())) for f, w in zip(features, weights))
        p = [1 / (1 + np.exp(-(eta - c))) for c in cuts]
        assert abs(s[k] - sum(p)) < 1e-5 and g[k] == sum(q >= 0.5 for q in p) and t[k] == (p[0] >= 0.5)
    assert s[0] < s[5] and s[1] == s[2] == s[4]


def test_model_size_is_a_parameter(spark):
    rows, labels = toxic_corpus(300)
    docs = docs_of(spark, rows)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    whole = toxicity.train(spark, docs, known)
    few = toxicity.train(spark, docs, known, features=3)
    assert len(few.features) == 3 < len(whole.features) and set(few.features) <= set(whole.features)
    assert not len(toxicity.train(spark, docs, known, min_toxic=10**6).features)


def test_toxicity_without_labels(spark):
    docs = docs_of(spark, [(1, "a b"), (2, None)])
    model = toxicity.train(spark, docs, spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int"))
    assert [tuple(r)[1:] for r in toxicity.score(docs, model).collect()] == [(0.0, 0, False)] * 2
    assert toxicity.keep_clean(docs, model).count() == 2


def test_licences(spark):
    mit = " ".join(licences.SENTENCES[i].capitalize() + "." for i in (10, 11)) + "\n" + licences.SENTENCES[12].upper()
    rows = [
        (1, "x\nReleased under the MIT License.\ny"),
        (2, mit),
        (3, licences.SENTENCES[31] + ".\n" + licences.SENTENCES[30]),  # wrong order
        (4, "\n".join(licences.SENTENCES[i] for i in (30, 1, 31, 32))),
        (5, None),
        (6, ""),
        (None, "Licensed under CC BY-NC 4.0."),
        (7, "Released under the MIT License. Released under the MIT License."),
    ]
    got = {(r.doc_id, r.rule, r.matches) for r in licences.licence_matches(docs_of(spark, rows)).collect()}
    assert got == {(1, "mit_released", 1), (2, "mit_text", 1), (4, "bsd_3_text", 1), (4, "mit_released", 1), (None, "cc_by_nc_4_notice", 1), (7, "mit_released", 2)}
    assert licences.licence_matches(docs_of(spark, [])).count() == 0


# openings of public licence texts, as published, one paragraph a line
PUBLIC_TEXTS = {
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that"
    " the above copyright notice and this permission notice appear in all copies.\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL"
    " WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF"
    " MERCHANTABILITY AND FITNESS.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as"
    " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as"
    " published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public"
    " License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public"
    " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this"
    " file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.\nAnyone is free to copy, modify, publish, use, compile, sell, or"
    " distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages"
    " arising from the use of this software.\nPermission is granted to anyone to use this software for any purpose, including commercial applications,"
    " and to alter it and redistribute it freely, subject to the following restrictions:",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC0-1.0": "Licensed under CC0 1.0.",
    "BSD-4-Clause": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
    " documentation and/or other materials provided with the distribution.\n3. All advertising materials mentioning features or use of this software"
    " must display the following acknowledgement: This product includes software.\n4. Neither the name of the copyright holder nor the names of its"
    " contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "MIT-0": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the"
    " \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,"
    " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.\nTHE SOFTWARE IS"
    " PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS"
    " FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "MIT": "Licensed under the MIT Licence.",
    "GPL-3.0-only": "This work is licensed under the GNU General Public Licence, version 3.",
}


def test_public_licence_texts(spark):
    names = list(PUBLIC_TEXTS)
    rows = [(k, "Some text.\n" + PUBLIC_TEXTS[x] + "\nMore text.") for k, x in enumerate(names)]
    found = {(names[r.doc_id], r.licence) for r in licences.licence_matches(docs_of(spark, rows)).collect()}
    assert found == {(x, x) for x in names}
    assert set(licences.SPELLINGS.values()) <= set(licences.SENTENCES)


def test_every_licence_sentence_has_an_anchor():
    assert all(any(a in s for a in licences.ANCHORS) for s in licences.SENTENCES.values())
    assert set(licences.SENTENCES) == {i for _, _, ids in licences.RULES for i in ids}


def test_sketches_bound_the_overlap():
    r = np.random.default_rng(7)
    for _ in range(200):
        n, m = r.integers(1, 400, 2)
        pool = r.integers(-(1 << 63), (1 << 63) - 1, 500)
        a, b = (np.unique(r.choice(pool, x)) for x in (n, m))
        if r.random() < 0.2:
            b = np.unique(np.r_[b, np.arange(600)])  # many in one bucket
        kind = pa.list_(pa.struct([("label", pa.int64()), ("tokens", pa.list_(pa.int64()))]))
        rows = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([[{"label": 1, "tokens": a.tolist()}], [{"label": 2, "tokens": b.tolist()}]], kind)], names=["gid", "members"])
        (out,) = jaccard._sketches([rows])
        assert out["least"].to_pylist() == [len(a), len(b)]
        assert jaccard._most_shared(*out["sketch"].to_pylist()) >= len(np.intersect1d(a, b))
    half = np.unique(r.integers(-(1 << 63), (1 << 63) - 1, 1000))
    rows = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([[{"label": 1, "tokens": x.tolist()}] for x in (half[:500], half[500:])], kind)], names=["gid", "members"])
    (out,) = jaccard._sketches([rows])
    assert jaccard._most_shared(*out["sketch"].to_pylist()) < 350  # nothing is shared, and a link needs 460
