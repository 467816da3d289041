"""Stored first months, value lists in parts, error mixes, and approximate candidates against the exact join."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketmill.operators import aggregates as ag
from ticketmill.operators import hyperplanes as hy
from ticketmill.operators import similarity as sm
from ticketmill.operators import vectors as vx
from ticketmill.plans import firsts as fi
from ticketmill.plans import marts as ma
from ticketmill.plans import runs

ROWS = [
    (date(2024, 1, 1), "a"), (date(2024, 1, 1), "a"), (date(2024, 1, 1), None), (date(2024, 2, 1), "b"), (date(2024, 2, 1), "a"),
    (date(2024, 3, 1), "a"), (date(2024, 4, 1), "c"), (date(2024, 4, 1), "b"), (None, "z"),
]


def table(spark, rows):
    return spark.createDataFrame(rows, "month_start date, root_cause string")


def values(df):
    return {r.root_cause: r.first_month for r in df.collect()}


def test_months_one_by_one_equal_one_run(spark, ws):
    whole = values(fi.update_first_months(ws, table(spark, ROWS), ws.path("whole"), "root_cause"))
    assert whole == {"a": date(2024, 1, 1), "b": date(2024, 2, 1), "c": date(2024, 4, 1)}
    out = ws.path("steps")
    for m in (1, 2, 3, 4, 4):
        own = [r for r in ROWS if r[0] and r[0].month == m]
        stored = fi.update_first_months(ws, table(spark, own), out, "root_cause")
    assert values(stored) == whole
    fresh = {r.month_start: r.new_values for r in fi.fresh_values(stored, table(spark, ROWS[:-1])).collect()}
    assert [fresh[date(2024, m, 1)] for m in (1, 2, 3, 4)] == [1, 1, 0, 1]
    flags = fi.flag_seen(table(spark, ROWS), stored, "root_cause").collect()
    assert sorted((str(r.month_start), r.root_cause) for r in flags if r.seen_before) == [("2024-02-01", "a"), ("2024-03-01", "a"), ("2024-04-01", "b")]
    assert len(flags) == len(ROWS)


def test_corrected_months_and_missing_ones(spark, ws):
    out = ws.path("firsts")
    fi.update_first_months(ws, table(spark, ROWS), out, "root_cause")
    corrected = [(date(2024, 2, 1), "c")] + [r for r in ROWS if r[0] and r[0].month > 2]
    got = values(fi.update_first_months(ws, table(spark, corrected), out, "root_cause"))
    assert got == {"a": date(2024, 1, 1), "c": date(2024, 2, 1), "b": date(2024, 4, 1)}
    with pytest.raises(ValueError, match="2024-04-01"):
        fi.update_first_months(ws, table(spark, corrected[:1]), out, "root_cause")
    assert values(fi.update_first_months(ws, table(spark, []), out, "root_cause")) == got
    assert fi.update_first_months(ws, table(spark, []), ws.path("none"), "root_cause").count() == 0


def test_value_parts_hold_every_value(spark, ws):
    rows = spark.range(100_000).select(F.lit(1).alias("g"), F.format_string("v%06d", "id").alias("label"))
    rows = rows.unionByName(spark.createDataFrame([(1, ""), (1, "nan"), (1, None), (2, "x"), (2, "x"), (3, None)], "g int, label string"))
    parts = ag.distinct_parts(ws, rows, "g", "label", size=30_000).orderBy("g", "part").collect()
    assert [(r.g, r.part, r.label.count(",") + 1) for r in parts] == [(1, 0, 30_000), (1, 1, 30_000), (1, 2, 30_000), (1, 3, 10_000), (2, 0, 1)]
    assert ", ".join(r.label for r in parts if r.g == 1) == ag.distinct_sorted(rows, ["g"], "label").where("g = 1").head().label


def test_error_mix_shows_types_nobody_listed(spark):
    rows = spark.createDataFrame([("f", "new"), ("f", "a"), ("f", "a"), ("f", None), ("g", "a")], "feature string, error_type string")
    got = {r.feature: (r.clusters, r.error_types, r.counts) for r in ma.error_mix_map(rows).collect()}
    assert got == {"f": (4, ["", "a", "new"], [1, 2, 1]), "g": (1, ["a"], [1])}


def test_dashboards_of_runs_equal_one_run(spark, ws):
    rng = np.random.default_rng(2)
    rows = [
        (date(2024, m, 1), c, f"f{c % 3}", f"e{rng.integers(2)}", f"r{rng.integers(m + 2)}", int(rng.integers(1, 4))) for m in range(1, 6) for c in range(1, 9)
    ]
    snapshot = spark.createDataFrame(rows, "month_start date, cluster_id long, feature string, error_type string, root_cause string, total_tickets long")
    out = ws.path("steps")
    for m in range(1, 6):
        now = F.lit(date(2024, m, 1))
        steps = runs.run_dashboards(ws, snapshot.where(F.col("month_start") <= now), out, now)
    whole = runs.run_dashboards(ws, snapshot, ws.path("whole"))
    for name, rows in whole.items():
        assert sorted(map(repr, rows.collect())) == sorted(map(repr, steps[name].collect())), name
    assert sum(r.new_root_causes for r in whole["month_health"].collect()) == snapshot.select("root_cause").distinct().count()


def test_candidates_are_right_and_recall_is_measured(spark, ws):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16))
    rows = [(i, [float(x) for x in centres[i % 20] + rng.normal(scale=0.25, size=16)]) for i in range(400)] + [(400, [0.0] * 16)]
    given = spark.createDataFrame(rows, "seq long, v array<double>")
    vectors = ws.save(vx.given_vectors(ws, given, "seq", "v", 16).withColumnRenamed("seq", "pos"), "rows")
    exact = {(r.l, r.r): r.sim for r in sm.cell_join(ws, vectors, None, 0.8, 16).collect()}
    found = ws.save(hy.approximate_pairs(ws, vectors, 0.8, 16), "found")
    got = {(r.l, r.r): r.sim for r in found.collect()}
    assert len(got) == found.count() and got.items() <= exact.items() and len(got) >= 0.9 * len(exact) > 0
    told = hy.recall(ws, vectors, found, 0.8, 16, every=5).head()
    left = {p for p in exact if p[0] % 5 == 0 or p[1] % 5 == 0}
    assert told.pairs == len(left) and told.found_pairs == len(left & got.keys())
    assert hy.approximate_pairs(ws, vectors.limit(0), 0.8, 16).count() == 0
    assert hy.recall(ws, vectors.where("pos = 400"), found, 0.8, 16).head().recall == 1.0


def test_bands_follow_from_the_recall_wanted():
    for t in (0.3, 0.6, 0.9):
        bits = hy.bits_for(t)
        same = (1 - np.arccos(t) / np.pi) ** bits
        assert 1 - (1 - same) ** hy.bands_for(t, bits) >= hy.TARGET and hy.bands_for(t, bits) <= hy.MOST_BANDS
    assert hy.bits_for(0.9) > hy.bits_for(0.3)
