from conftest import rows
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexiweave import sources as S
from lexiweave.operators.index import skip_done


def test_grouped_lines_number_each_file_from_zero(spark, tmp_path):
    (tmp_path / "film one.txt").write_text("a\n\nb b\n", encoding="utf-8")
    (tmp_path / "影+2.txt").write_text("c\n", encoding="utf-8")
    got = rows(S.read_grouped_lines(spark, str(tmp_path)), "group_id", "doc_id", "text")
    assert got == sorted([("film one", 0, "a"), ("film one", 1, ""), ("film one", 2, "b b"), ("影+2", 0, "c")])


def test_line_numbers_run_on_over_splits(spark, tmp_path):
    lines = [f"line {i}" for i in range(5000)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        got = rows(S.read_grouped_lines(spark, str(tmp_path)), "doc_id", "text")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == list(enumerate(lines))


def test_category_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1234\n12345\n\nx/y//z/\n")
    (tmp_path / "b.txt").write_text("y/longer\n")
    got = rows(S.read_category_lines(spark, str(tmp_path)), "label", "pos", "term")
    assert got == [(0, 0, "12345"), (1, 0, "x"), (1, 1, "y"), (1, 2, "z"), (2, 0, "y"), (2, 1, "longer")]


def test_weighted_terms_cut_at_the_last_backtick(spark, tmp_path):
    (tmp_path / "one").write_text("a`0.9\n`0.8\n``0.75\nbad`x\n")
    (tmp_path / "two").write_text("b`0.3\na`0.25\n")
    got = rows(
        S.read_weighted_terms(spark, [(str(tmp_path / "one"), False), (str(tmp_path / "two"), True)]),
        "idx", "term", "weight",
    )
    assert got == [(0, "a", 0.75), (1, "`", 0.75), (2, "b", 0.7)]


def test_postings_round_trip_with_split_lists(spark, tmp_path):
    data = [("g", "a:b", i) for i in range(25)] + [("g", "c", 3), ("h", "c", 9)]
    df = spark.createDataFrame(data, "group_id string, term string, doc_id bigint")
    S.write_postings(df, str(tmp_path / "p"), per_line=10)
    assert rows(S.read_postings(spark, str(tmp_path / "p")), "group_id", "term", "doc_id") == sorted(data)
    lines = [r.value for r in spark.read.text(str(tmp_path / "p")).collect()]
    assert "c:[3]" in lines and len(lines) > 4


def test_libsvm_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1.0, Vectors.sparse(5, {0: 1.0, 3: 0.5})), (0.0, Vectors.sparse(5, {}))], ["label", "features"])
    S.write_libsvm(df, str(tmp_path / "v"))
    got = {r.label: r.features for r in S.read_libsvm(spark, str(tmp_path / "v"), 5).collect()}
    assert got == {1.0: Vectors.sparse(5, {0: 1.0, 3: 0.5}), 0.0: Vectors.sparse(5, {})}


def test_cluster_members_and_membership(spark, tmp_path):
    (tmp_path / "m.txt").write_text("2:0,5,7\n0:1\n\n")
    assert rows(S.read_cluster_members(spark, str(tmp_path / "m.txt"))) == [(0, 1), (2, 0), (2, 5), (2, 7)]
    labels = spark.createDataFrame([(4, "1 2 3")], "member bigint, labels string")
    S.write_membership(labels, str(tmp_path / "l"))
    assert [r.value for r in spark.read.text(str(tmp_path / "l")).collect()] == ["4:1 2 3 "]
    assert rows(S.read_membership(spark, str(tmp_path / "l"))) == [(4, "1 2 3")]


def test_tag_counts_are_sorted_inside_a_cluster(spark, tmp_path):
    counts = spark.createDataFrame([(0, "a", 1), (0, "b", 5), (0, "c", 5), (1, "a", 2)], "cluster int, tag string, n bigint")
    S.write_tag_counts(counts.coalesce(1), str(tmp_path / "t"))
    files = sorted((tmp_path / "t" / "cluster=0").glob("part-*"))
    assert [line for f in files for line in f.read_text().split()] == ["b:5", "c:5", "a:1"]


def test_graph_files(spark, tmp_path):
    nodes = spark.createDataFrame([("g", 0, "a", 3, 0), ("g", 1, "b", 2, 0)], "group_id string, node bigint, term string, size bigint, slot bigint")
    edges = spark.createDataFrame([("g", "a", "b", 2), ("g", "a", "gone", 9)], "group_id string, src string, dst string, w bigint")
    S.write_graph(nodes, edges, str(tmp_path / "g"))
    assert rows(S.read_graph_nodes(spark, str(tmp_path / "g")), "group_id", "node", "term", "size", "slot") == [("g", 0, "a", 3, 0), ("g", 1, "b", 2, 0)]
    assert rows(S.read_graph_edges(spark, str(tmp_path / "g")), "group_id", "v1", "v2", "w") == [("g", 0, 1, 2)]


def test_skip_done(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "group_id string, doc_id bigint")
    done = df.where("group_id = 'a'").select("group_id", F.lit(1).alias("x"))
    assert rows(skip_done(df, done)) == [("b", 2), ("b", 3)]


def test_finished_groups_are_not_opened(spark, tmp_path):
    given, output = tmp_path / "given", tmp_path / "output"
    given.mkdir()
    for name in ("a", "b c", "d+e", "f%g", "h[1]"):
        (given / f"{name}.txt").write_text(f"first {name}\nsecond")
    assert S.pending_files(spark, str(given), str(output)) == sorted(f"file:{given}/{n}.txt" for n in ("a", "b c", "d+e", "f%g", "h[1]"))
    lines = S.read_pending_lines(spark, str(given), str(output))
    assert lines.count() == 10
    lines.where(F.col("group_id").isin("a", "b c", "d+e", "f%g")).write.partitionBy("group_id").csv(str(output))
    assert rows(S.finished_groups(spark, str(output))) == [("a",), ("b c",), ("d+e",), ("f%g",)]
    # The files of finished groups are made unreadable: opening one would fail.
    for name in ("a", "b c", "d+e", "f%g"):
        (given / f"{name}.txt").write_bytes(b"changed since")
    assert S.pending_files(spark, str(given), str(output)) == [f"file:{given}/h[1].txt"]
    rest = S.read_pending_lines(spark, str(given), str(output))
    assert rows(rest, "group_id", "doc_id", "text") == [("h[1]", 0, "first h[1]"), ("h[1]", 1, "second")]
    rest.write.partitionBy("group_id").mode("append").csv(str(output))
    assert S.read_pending_lines(spark, str(given), str(output)).count() == 0
