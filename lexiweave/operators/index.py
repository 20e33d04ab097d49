"""Inverted index and co-occurrence graph.

Postings have the columns ``(group_id, term, doc_id)``, one row per pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import WORD_BREAK, words
from ..functions.fields import drop_empty
from ..functions.rows import explode_once
from .pairs import pair_counts
from ..runtime import (
    dense_index,
    fits_broadcast,
    keyed_join,
    lookup_join,
    materialize,
    spread_aggregate,
    task_count,
)

# Most blocks that the terms of a group are dealt into for the sake of tasks, least tasks that count pairs, and
# most terms of a block.
PAIR_RANGES = 32
PAIR_TASKS = 32
PAIR_BLOCK = 4096
# Letters of an anchor, and of the longest term that is looked up by its anchor alone.
ANCHOR = 3
LONGEST = 64
# Letters that a segment of a long run goes on by.
SEGMENT = 512


def assign_doc_id(df: DataFrame, order_by: Sequence[str], out: str = "doc_id") -> DataFrame:
    """Position of each row in the order of a unique key."""
    return dense_index(df, [F.asc(c) for c in order_by], out)


def first_occurrence_id(docs: DataFrame, text: str = "text") -> DataFrame:
    """Smallest id of the documents of the group that have the same text.

    Texts are compared by their SHA-256 digest, which is worked out once, so they are
    not shuffled, and a text that makes up a large part of a group is no hot task.
    """
    keyed = docs.select("group_id", "doc_id", F.unhex(F.sha2(text, 256)).alias("_digest"))
    return spread_aggregate(
        keyed, ["group_id", "_digest"], F.col("doc_id"), F.min, "first_id"
    ).select("group_id", "doc_id", "first_id")


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs (group_id, doc_id, text)`` with one row per text of a group: the one with the smallest id.

    Only digests and ids are shuffled, and only texts that occur more than once are looked up.
    """
    keyed = docs.select("group_id", "doc_id", text, F.unhex(F.sha2(text, 256)).alias("_digest"))
    rows = keyed.groupBy("group_id", "_digest", "doc_id").agg(F.count("*").alias("_rows"))
    copies = rows.groupBy("group_id", "_digest").agg(
        F.min("doc_id").alias("_first"), F.sum("_rows").alias("_n"), F.max("_rows").alias("_rows")
    )
    copies = materialize(copies.where("_n > 1").drop("_n"), "copies")
    first = F.coalesce(F.col("_first") == F.col("doc_id"), F.lit(True))
    single = lookup_join(keyed, copies, ["group_id", "_digest"], ["doc_id"], "left").where(first)
    if not copies.where("_rows > 1").isEmpty():
        # Rows that are repeated as a whole.
        single = single.dropDuplicates(["group_id", "doc_id", "_digest"])
    return single.select("group_id", "doc_id", text)


def postings(
    docs: DataFrame, vocabulary: DataFrame, match: str = "token", merge_copies: bool = True
) -> DataFrame:
    """Documents that hold each vocabulary term ``(group_id, term)``.

    With ``merge_copies`` equal texts of a group count once, under their smallest id; the copies are left out
    before words are split.
    """
    if match not in ("token", "substring"):
        raise ValueError("match is 'token' or 'substring'")
    single = docs.select("group_id", "doc_id", "text")
    if merge_copies:
        single = distinct_texts(single)
    if match == "substring":
        return substring_postings(single, vocabulary)
    tokens = explode_once(single, ["group_id", "doc_id"], F.array_distinct(words(F.col("text"))))
    return lookup_join(tokens, vocabulary.select("group_id", "term"), ["group_id", "term"], ["doc_id"])


def _segments(run):
    """A run of letters and digits in pieces of bounded length that overlap, so that every term lies in one."""
    starts = F.sequence(F.lit(0), F.floor((F.length(run) - 1) / SEGMENT).cast("int"))
    cut = F.transform(starts, lambda k: F.substring(run, k * SEGMENT + 1, F.lit(SEGMENT + LONGEST - 1)))
    return F.when(F.length(run) <= SEGMENT + LONGEST, F.array(run)).otherwise(cut)


def _piece_table(terms: DataFrame) -> DataFrame:
    """Each term beside its anchor: the piece of three letters that fewest terms of its group hold.

    ``(group_id, piece, at, term)``; a term of one or two letters is its own anchor.
    """
    size = F.least(F.length("term"), F.lit(ANCHOR))
    cut = terms.select("group_id", "term", F.explode(F.sequence(F.lit(1), F.length("term") - size + 1)).alias("at"), size.alias("size"))
    cut = materialize(cut.select("group_id", "term", "at", F.expr("substring(term, at, size)").alias("piece")), "pieces")
    held = cut.groupBy("group_id", "piece").agg(F.count("*").alias("held"))
    ranked = lookup_join(cut, held, ["group_id", "piece"], ["term"])
    best = ranked.groupBy("group_id", "term").agg(F.min(F.struct("held", "at", "piece")).alias("best"))
    return best.select("group_id", F.col("best.piece").alias("piece"), F.col("best.at").alias("at"), "term")


def substring_postings(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Documents whose lower-cased text holds the term as a substring.

    A term of letters and digits lies inside one run of letters and digits, and holds its anchor, a piece of
    at most three letters. So the pieces of each distinct run are joined to the anchors, and the term is compared
    around its anchor: a run of n letters gives up to n look-ups per length of anchors. Long runs are cut into
    overlapping segments. A term with other characters, or one longer than the overlap, is looked up by the first
    letters of its longest run and then tested against the texts that hold those; one without letters and digits
    is tested against the texts of its group.
    """
    vocab = materialize(vocabulary.select("group_id", "term").distinct(), "vocabulary")
    plain = ~F.rlike("term", F.lit(WORD_BREAK)) & (F.length("term") <= LONGEST) & (F.length("term") > 0)
    compact = vocab.where(plain)
    pieces = drop_empty(F.split(F.lower("term"), WORD_BREAK))
    core = F.array_max(F.transform(pieces, lambda x: F.struct(F.length(x).alias("n"), x.alias("core"))))["core"]
    other = materialize(vocab.where(~plain).withColumn("core", F.substring(core, 1, LONGEST)), "other_terms")
    cores = other.where("core is not null").select("group_id", F.col("core").alias("term")).distinct()
    anchors = materialize(_piece_table(compact.unionByName(cores).distinct()), "anchors")

    split = F.array_distinct(F.flatten(F.transform(drop_empty(F.split(F.lower("text"), WORD_BREAK)), _segments)))
    runs = materialize(explode_once(docs, ["group_id", "doc_id"], split, "run"), "runs")
    sizes = anchors.select("group_id", F.length("piece").alias("_size")).distinct()
    by_group = sizes.groupBy("group_id").agg(F.collect_set("_size").alias("_sizes"))
    probes = (
        lookup_join(runs.select("group_id", "run").distinct(), by_group, ["group_id"], ["run"])
        .withColumn("_size", F.explode("_sizes"))
        .where(F.col("_size") <= F.length("run"))
        .withColumn("_start", F.explode(F.sequence(F.lit(1), F.length("run") - F.col("_size") + 1)))
        .withColumn("piece", F.expr("substring(run, _start, _size)"))
    )
    met = lookup_join(probes, anchors, ["group_id", "piece"], ["run"])
    begin = F.col("_start") - F.col("at") + 1
    same = (begin >= 1) & (F.substring("run", begin, F.length("term")) == F.col("term"))
    # One row per run with the terms inside it, so the rows of a run do not multiply in the join.
    inside = met.where(same).groupBy("group_id", "run").agg(F.collect_set("term").alias("inside"))
    found = lookup_join(runs, materialize(inside, "matches"), ["group_id", "run"], ["doc_id"])
    inside = explode_once(found, ["group_id", "doc_id"], "inside").distinct()
    if other.isEmpty():
        return inside
    inside = materialize(inside, "inside")
    whole = lookup_join(inside, compact, ["group_id", "term"], ["doc_id"], "left_semi")
    named = other.where("core is not null").select("group_id", "core", "term")
    asked = lookup_join(inside.withColumnRenamed("term", "core"), named, ["group_id", "core"], ["doc_id"])
    texts = docs.select("group_id", "doc_id", "text")
    across = asked.select("group_id", "doc_id", "term").join(texts, ["group_id", "doc_id"])
    across = across.where(F.contains(F.lower("text"), F.col("term")))
    marks = other.where("core is null").select("group_id", "term")
    bare = lookup_join(texts, marks, ["group_id"], ["doc_id"]).where(F.contains(F.lower("text"), F.col("term")))
    columns = ["group_id", "doc_id", "term"]
    every = whole.select(*columns).unionByName(across.select(*columns)).unionByName(bare.select(*columns))
    return every.distinct()


def doc_frequency(postings_df: DataFrame) -> DataFrame:
    """Number of documents per term."""
    return postings_df.groupBy("group_id", "term").agg(F.count("*").alias("df"))


def posting_intersection_size(postings_df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Number of documents that the postings of two terms share, for given ``(group_id, src, dst)``.

    Pairs that share none are left out.
    """
    asked = pairs.select("group_id", "src", "dst").distinct().withColumn("pair", F.monotonically_increasing_id())
    asked = materialize(asked, "asked")
    # A posting is listed under the number of every pair that asks for its term, and meets the other end there.
    ends = F.explode(F.array(F.struct(F.col("src").alias("term"), F.lit(True).alias("first")), F.struct(F.col("dst").alias("term"), F.lit(False).alias("first"))))
    listed = asked.select("group_id", "pair", ends.alias("e")).select("group_id", "e.term", "pair", "e.first")
    met = lookup_join(postings_df.select("group_id", "term", "doc_id"), listed, ["group_id", "term"], ["doc_id"])
    shared = (
        met.where(F.col("doc_id").isNotNull())
        .groupBy("pair", "doc_id")
        .agg((F.count_if("first") * F.count_if(~F.col("first"))).alias("both"))
        .groupBy("pair")
        .agg(F.sum("both").alias("w"))
    )
    return lookup_join(asked, materialize(shared.where("w > 0"), "shared"), ["pair"], ["src"]).select("group_id", "src", "dst", "w")


def _pair_blocks(numbered: DataFrame, tasks: int) -> DataFrame:
    """``(group_id, part, blocks)``: first number of the group, and into how many blocks its terms are dealt.

    There are enough tiles for all tasks, shared among the groups by their postings, and no block holds more than
    ``PAIR_BLOCK`` terms, so the counts of a tile fit a task for any vocabulary.
    """
    groups = materialize(
        numbered.groupBy("group_id").agg(F.min("tid").alias("part"), F.count("*").alias("n_terms"), F.sum("df").alias("n")), "groups"
    )
    total = groups.agg(F.sum("n").cast("double")).first()[0] or 1.0
    spread = F.least(F.ceil(F.sqrt(2.0 * tasks * F.col("n") / total)), F.lit(PAIR_RANGES))
    blocks = F.greatest(F.least(spread, F.col("n_terms")), F.ceil(F.col("n_terms") / PAIR_BLOCK), F.lit(1))
    return groups.select("group_id", "part", blocks.cast("int").alias("blocks"))


def cooccurrence(postings_df: DataFrame, theta: DataFrame) -> DataFrame:
    """Edges ``(group_id, src, dst, w)``: pairs of terms that more than theta documents hold.

    ``theta`` is ``(group_id, theta)``. A term in no more than theta documents cannot have
    such an edge, so it is left out before pairs are built; the result is the same.

    Terms of a group are dealt into blocks. A document goes to every pair of its blocks (a tile) with the terms of
    those two, so all documents with a pair of terms meet in one tile: its count is complete there, pairs up to
    theta end there too, and no pair is shuffled. A very frequent term is in many tiles, like any document.
    """
    theta = materialize(theta.select("group_id", "theta"), "theta")
    frequency = lookup_join(doc_frequency(postings_df), theta, ["group_id"], ["term"])
    alive = frequency.where(F.col("df") > F.col("theta")).select("group_id", "term", "df")

    # Terms become numbers that keep their order.
    numbered = dense_index(alive, [F.asc("group_id"), F.asc("term")], "tid")
    small = fits_broadcast(numbered)
    names = numbered.select("group_id", "term", "tid")
    coded = keyed_join(postings_df.select("group_id", "term", "doc_id"), names, ["group_id", "term"], ["doc_id"], small)

    tasks = max(task_count(postings_df.sparkSession), PAIR_TASKS)
    limits = materialize(lookup_join(_pair_blocks(numbered, tasks), theta, ["group_id"], ["part"]), "limits")
    most_blocks = limits.agg(F.max("blocks")).first()[0] or 1
    per_doc = coded.select("group_id", "doc_id", "tid").repartition("group_id", "doc_id").groupBy("group_id", "doc_id").agg(
        F.collect_set("tid").alias("tids")
    )
    lists = lookup_join(per_doc.where(F.size("tids") > 1), limits, ["group_id"], ["doc_id"])
    numbers = F.transform("tids", lambda x: (x - F.col("part")).cast("int"))
    counts = pair_counts(lists.select("part", "blocks", F.col("theta").cast("double").alias("theta"), numbers.alias("numbers")), tasks, most_blocks)
    src = numbered.select(F.col("tid").alias("a"), "group_id", F.col("term").alias("src"))
    dst = numbered.select(F.col("tid").alias("b"), F.col("term").alias("dst"))
    edges = keyed_join(keyed_join(counts, src, ["a"], ["b"], small), dst, ["b"], ["a"], small)
    return edges.select("group_id", "src", "dst", "w")


def skip_done(df: DataFrame, existing: DataFrame, key: str = "group_id", spread_by=("doc_id",)) -> DataFrame:
    """Rows of groups that have no output yet."""
    return lookup_join(df, existing.select(key).distinct(), [key], spread_by, how="left_anti")
