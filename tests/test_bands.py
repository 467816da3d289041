"""Approximate candidates: a pair that several bands share."""

from test_blocks import rows, unit
from ticketmill.operators import hyperplanes as hy


def test_a_pair_of_several_bands_is_found_once_without_being_made_distinct(spark, ws):
    x = unit(3, 80, 6, 4)
    x[40:] = x[:40]
    table = rows(spark, x).union(rows(spark, x[:3]))  # rows that come twice, too
    found = hy.approximate_pairs(ws, table, 0.7, 6)
    pairs = [(p.l, p.r) for p in found.collect()]
    assert len(pairs) == len(set(pairs)) and {(i, i + 40) for i in range(40)} <= set(pairs)
    assert "HashAggregate" not in found._jdf.queryExecution().executedPlan().toString().split("FlatMapGroupsInArrow")[0]
