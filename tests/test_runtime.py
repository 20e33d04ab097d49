import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lexiweave import runtime
from lexiweave.operators.index import first_occurrence_id
from lexiweave.runtime import dense_index, fits_broadcast, lookup_join, spread_aggregate


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key."""
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("key")
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_is_the_plain_join_at_any_size(spark, skewed, how):
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(50)], "key string, v int")
    want = rows(skewed.join(right, "key", how))
    assert rows(lookup_join(skewed, right, ["key"], ["id"], how)) == want
    assert rows(lookup_join(skewed, right, ["key"], ["id"], how, max_bytes=0)) == want


def test_salted_join_takes_several_rows_per_key(spark, skewed):
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3)], "key string, v int")
    assert rows(lookup_join(skewed, right, ["key"], ["id"], max_bytes=0)) == rows(skewed.join(right, "key"))


def test_fits_broadcast_measures_bytes(spark):
    df = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert fits_broadcast(df, 20_000) and not fits_broadcast(df, 9_000)


def test_spread_aggregate(spark, skewed):
    got = spread_aggregate(skewed, ["key"], F.col("id"), F.min, "low")
    want = {}
    for r in skewed.collect():
        want[r.key] = min(want.get(r.key, r.id), r.id)
    assert all(r.low == want[r.key] for r in got.collect()) and got.count() == 3000


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_dense_index_does_not_depend_on_partitions(spark, parts):
    values = list(range(500))
    random.Random(parts).shuffle(values)
    df = spark.createDataFrame([(v % 7, v) for v in values], "g int, v int").repartition(parts)
    whole = {r.v: r.idx for r in dense_index(df, [F.desc("v")]).collect()}
    assert whole == {v: 499 - v for v in values}
    inside = dense_index(df, [F.asc("g"), F.asc("v")], "idx", within=["g"]).collect()
    for g in range(7):
        assert [r.idx for r in sorted((r for r in inside if r.g == g), key=lambda r: r.v)] == list(
            range(len([v for v in values if v % 7 == g]))
        )


def test_first_occurrence_of_equal_texts(spark):
    docs = spark.createDataFrame(
        [("a", 5, "same"), ("a", 2, "same"), ("a", 3, "other"), ("b", 9, "same"), ("a", 7, "")],
        "group_id string, doc_id bigint, text string",
    )
    assert rows(first_occurrence_id(docs)) == [("a", 2, 2), ("a", 3, 3), ("a", 5, 2), ("a", 7, 7), ("b", 9, 9)]


def test_scratch_tables_go_to_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert runtime.scratch_root(spark) == named
    stored = runtime.materialize(spark.range(3), "t")
    assert stored.count() == 3 and all(named in path for path in stored.inputFiles())
