import pytest
from conftest import rows
from pyspark.sql import functions as F

from lexiweave.functions import (
    blank_split,
    class_flag,
    contains_both,
    extract_field,
    graph_theta,
    index_theta,
    min_part_size,
    parse_group_id,
    profile_tag_array,
    split_values,
    words,
)
from lexiweave.operators.affinity import class_affinity, group_affinity, tag_affinity, two_sided_affinity, word_affinity
from lexiweave.operators.terms import (
    adaptive_frequent_terms,
    build_vocabulary,
    doc_count,
    frequent_terms,
    rank_desc,
    term_counts,
    top_k,
    union_vocabularies,
)
from lexiweave.operators.tokens import keep_classes, whitespace_tokenize


def one(spark, value, expression, name="v"):
    return spark.createDataFrame([(value,)], f"{name} string").select(expression.alias("r")).first()["r"]


def test_extract_field_takes_the_first_pair_and_omits_empty_ones(spark):
    line = "<sex>f</sex><tag>a,b</tag><tag>c</tag><words></words>"
    assert one(spark, line, extract_field(F.col("v"), "tag")) == "a,b"
    assert one(spark, line, extract_field(F.col("v"), "words")) is None
    assert one(spark, line, extract_field(F.col("v"), "group")) is None


def test_class_flag(spark):
    assert one(spark, "<sex>m</sex>", class_flag(F.col("v"), "<sex>m</sex>")) == 1
    assert one(spark, "no marker", class_flag(F.col("v"), "<sex>m</sex>")) == 0


def test_split_values_drops_all_empty_items(spark):
    assert one(spark, "a,,b,,", split_values(F.col("v"))) == ["a", "b"]
    assert one(spark, "a.b.", split_values(F.col("v"), ".")) == ["a", "b"]


def test_profile_tags_in_field_order_without_missing_fields(spark):
    line = "<sex>f</sex><age>20</age><collection>x,,y,</collection>"
    assert one(spark, line, profile_tag_array(F.col("v"))) == ["20", "f", "x", "y"]


@pytest.mark.parametrize("path, want", [("a/b/film7.txt", "film7"), ("film8", "film8"), ("/x/y.z.txt", "y.z")])
def test_parse_group_id(spark, path, want):
    assert one(spark, path, parse_group_id(F.col("v"))) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("Hello, World 42!", ["hello", "world", "42"]),
        ("", []),
        ("ab中文字x y 中 z文字", ["ab", "中文", "文字", "x", "y", "中", "z", "文字"]),
        ("Élan-vital", ["élan", "vital"]),
        ("\U0001f600 ok", ["ok"]),
    ],
)
def test_words(spark, text, want):
    assert one(spark, text, words(F.col("v"))) == want


def test_blank_split_keeps_inner_blanks_like_the_ml_stage(spark):
    df = spark.createDataFrame([(1, "A  b c  ")], "id int, text string")
    ours = df.select(blank_split(F.col("text")).alias("terms")).first()["terms"]
    assert ours == ["a", "", "b", "c"]
    assert whitespace_tokenize(df).first()["terms"] == ours


def test_contains_both(spark):
    assert one(spark, "abc def", contains_both(F.col("v"), F.lit("bc"), F.lit("de"))) is True
    assert one(spark, "abc", contains_both(F.col("v"), F.lit("bc"), F.lit("de"))) is False


def test_threshold_steps(spark):
    df = spark.createDataFrame([(n,) for n in (3, 9, 10, 19, 20, 29, 30, 99, 100, 999, 1000)], "n bigint")
    got = {r.n: (r.i, r.g, r.m) for r in df.select("n", index_theta(F.col("n")).alias("i"), graph_theta(F.col("n")).alias("g"), min_part_size(F.col("n")).alias("m")).collect()}
    assert {n: v[0] for n, v in got.items()} == {3: 0, 9: 0, 10: 0, 19: 0, 20: 0, 29: 0, 30: 0, 99: 0, 100: 5, 999: 49, 1000: 50}
    assert got[9][1] == 0 and got[10][1] == 1 and got[99][1] == 1
    assert got[100][1] == pytest.approx(5.0) and got[999][1] == pytest.approx(49.95) and got[1000][1] == 50
    assert [got[n][2] for n in (9, 10, 19, 20, 29, 30)] == [3, 4, 4, 5, 5, 6]


def records(spark):
    data = []
    for i in range(6):
        data.append((1, ["six", "share60", "twice", "twice"]))
    for i in range(5):
        data.append((1, ["five"]))
    for i in range(4):
        data.append((0, ["share60"]))
    for i in range(7):
        data.append((0, ["neg7", "neg7"]))
    for i in range(3):
        data.append((1, ["neg7"]))
    return spark.createDataFrame(data, "label int, terms array<string>")


def test_word_affinity_counts_records_and_has_open_support(spark):
    got = {r.term: (r.pos, r.neg, r.share) for r in word_affinity(records(spark)).collect()}
    assert got["six"] == (6, 0, 1.0)
    assert got["twice"][:2] == (6, 0)
    assert got["share60"][2] == pytest.approx(0.6)
    assert "five" not in got and "neg7" not in got


def test_group_tag_and_two_sided_affinity(spark):
    data = records(spark)
    groups = {r.term: (r.pos, r.neg) for r in group_affinity(data).collect()}
    assert groups == {"neg7": (3, 14)}
    exact = class_affinity(data, distinct=True, support=F.col("neg") > 5, low=0.0, high=0.3)
    assert rows(exact, "term", "pos", "neg") == [("neg7", 3, 7)]
    edge = class_affinity(data, distinct=True, support=F.col("neg") > 5, low=0.0, high=0.3, include_high=False)
    assert edge.count() == 0
    assert {r.term for r in tag_affinity(data).collect()} == {"neg7"}
    assert {r.term for r in two_sided_affinity(data).collect()} == {"neg7"}


def test_frequent_terms_and_vocabulary_order(spark):
    tokens = spark.createDataFrame([("aa",)] * 4 + [("bb",)] * 4 + [("c",)] * 9 + [("dd",)] * 3, "term string")
    kept = frequent_terms(term_counts(tokens))
    assert rows(build_vocabulary(kept), "term", "idx", "n") == [("aa", 0, 4), ("bb", 1, 4)]


def test_adaptive_threshold_uses_the_size_of_each_group(spark):
    docs = spark.range(100).select(F.lit("big").alias("group_id"), F.col("id").alias("doc_id")).unionByName(
        spark.range(3).select(F.lit("small").alias("group_id"), F.col("id").alias("doc_id"))
    )
    counts = spark.createDataFrame(
        [("big", "four", 4), ("big", "five", 5), ("small", "one", 1), ("small", "x", 9)],
        "group_id string, term string, n bigint",
    )
    got = adaptive_frequent_terms(counts, doc_count(docs))
    assert rows(got, "group_id", "term") == [("big", "five"), ("small", "one")]


def test_union_keeps_first_place_and_last_weight(spark):
    first = spark.createDataFrame([("a", 0, 0.9), ("b", 1, 0.8)], "term string, pos bigint, weight double")
    second = spark.createDataFrame([("c", 0, 0.7), ("a", 1, 0.2)], "term string, pos bigint, weight double")
    assert rows(union_vocabularies([first, second]), "idx", "term", "weight") == [(0, "a", 0.2), (1, "b", 0.8), (2, "c", 0.7)]


def test_rank_and_top_k_break_ties_by_name(spark):
    df = spark.createDataFrame([("g", "b", 2), ("g", "a", 2), ("g", "c", 3), ("h", "z", 1)], "g string, term string, n int")
    assert [r.term for r in rank_desc(df, "n", "term").collect()] == ["c", "a", "b", "z"]
    assert rows(top_k(df, 2, ["g"], "n", "term"), "g", "rank", "term") == [("g", 1, "c"), ("g", 2, "a"), ("h", 1, "z")]


def test_keep_classes_tests_the_class_only(spark):
    tokens = spark.createDataFrame([(1, "navi"), (1, "dog"), (2, "run")], "doc_id bigint, term string")
    lexicon = spark.createDataFrame([("navi", "other"), ("dog", "noun"), ("run", "verb")], "term string, class string")
    assert rows(keep_classes(tokens, lexicon, ["noun", "verb"]), "term") == [("dog",), ("run",)]


def test_classes_are_looked_up_once_for_a_term_of_a_group(spark, tmp_path, monkeypatch):
    from lexiweave.registry import QUERIES, Tables, text_queries

    docs = [(i, "low low low fig " * 20 + "zebra early", "en" if i % 2 else "de") for i in range(12)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    seen, kept = [], text_queries.keep_classes
    monkeypatch.setattr(text_queries, "keep_classes", lambda words, *rest: seen.append(words.count()) or kept(words, *rest))
    got = QUERIES["tok3_keep_classes"].run(Tables(spark, str(tmp_path)))
    assert got.columns == ["group_id", "term", "n"]
    assert sorted(map(tuple, got.collect())) == sorted((g, t, n) for g in ("en", "de") for t, n in (("early", 6), ("fig", 120), ("low", 360)))
    assert seen == [8]
