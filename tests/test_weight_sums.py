from conftest import rows
from test_graph import EDGES


def test_sums_of_weights_beyond_a_long_are_compared(spark):
    from lexiweave.registry.graph_queries import _community_checks

    edges = spark.createDataFrame([("g", "a", "b", 1 << 33), ("g", "c", "d", 1 << 33), ("g", "a", "c", 1)], EDGES)
    terms = spark.createDataFrame([("g", t) for t in "abcd"], "group_id string, term string")
    found = spark.createDataFrame([("g", t, c) for t, c in zip("abcd", "aacc")], "group_id string, term string, community string")
    assert rows(_community_checks(terms, edges, found)) == [("g", 4, 4, 0, 0)]
    apart = spark.createDataFrame([("g", t, t) for t in "abcd"], "group_id string, term string, community string")
    assert [r.improving_merges for r in _community_checks(terms, edges, apart).collect()] == [2]
