"""Fields, words, term counts, affinity and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fields import (
    class_flag,
    contains_both,
    contains_term,
    extract_field,
    parse_group_id,
    profile_tag_array,
    split_values,
)
from ..operators.affinity import group_affinity, tag_affinity, two_sided_affinity, word_affinity, class_counts
from ..operators.clusters import assign_soft
from ..operators.index import assign_doc_id, first_occurrence_id, skip_done
from ..operators.terms import (
    adaptive_frequent_terms,
    build_vocabulary,
    doc_count,
    frequent_terms,
    rank_desc,
    term_counts,
    union_vocabularies,
)
from ..operators.tokens import (
    blank_tokenize,
    distinct_tokens,
    explode_tokens,
    keep_classes,
    tokenize,
    whitespace_tokenize,
)
from ..operators.vectors import drop_thin_rows
from .base import (
    SQL_INDEX_VOCABULARY,
    SQL_LABELLED,
    SQL_LABELLED_ALL,
    SQL_PROFILES,
    SQL_TOKENS,
    SQL_WORDS,
    query,
)

DOC_WORDS = SQL_WORDS.format("text")


@query(
    "fld1_extract_field",
    r"""SELECT page_id, nullif(regexp_extract(html, '<title>(.*?)</title>', 1), '') AS title,
      nullif(regexp_extract(html, '<li>(.*?)</li>', 1), '') AS item,
      nullif(regexp_extract(html, '<absent>(.*?)</absent>', 1), '') AS absent FROM pages""",
)
def _(t):
    html = F.col("html")
    return t.pages.select(
        "page_id",
        extract_field(html, "title").alias("title"),
        extract_field(html, "li").alias("item"),
        extract_field(html, "absent").alias("absent"),
    )


@query("fld2_class_flag", """SELECT page_id, CAST(contains(html, 'lang="en"') AS INT) AS flag FROM pages""")
def _(t):
    return t.pages.select("page_id", class_flag(F.col("html"), 'lang="en"').alias("flag"))


@query(
    "fld3_split_values",
    """SELECT page_id, unnest(s) AS part, generate_subscripts(s, 1) - 1 AS pos FROM (
      SELECT page_id, list_filter(string_split(url, '/'), lambda x: x <> '') AS s FROM pages)""",
)
def _(t):
    parts = split_values(F.col("url"), "/")
    return t.pages.select("page_id", F.posexplode(parts).alias("pos", "part")).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


@query(
    "fld4_profile_tags",
    f"""WITH {SQL_PROFILES} SELECT member, unnest(tags) AS tag, generate_subscripts(tags, 1) - 1 AS pos
      FROM taglist""",
)
def _(t):
    return t.profile_lines().select(
        "member", F.posexplode(profile_tag_array(F.col("raw"))).alias("pos", "tag")
    ).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "fld5_parse_group_id",
    r"""SELECT page_id, regexp_extract(url || '.txt', '([^/]+?)(\.txt)?$', 1) AS group_id FROM pages""",
)
def _(t):
    return t.pages.select("page_id", parse_group_id(F.concat("url", F.lit(".txt"))).alias("group_id"))


@query(
    "tok1_tokenize",
    f"""SELECT doc_id, count(*) AS n_words, count(DISTINCT term) AS n_distinct,
      CAST(sum(length(term)) AS BIGINT) AS chars, min(term) AS first, max(term) AS last
      FROM (SELECT doc_id, unnest({DOC_WORDS}) AS term FROM documents) GROUP BY 1""",
)
def _(t):
    tokens = explode_tokens(tokenize(t.documents.select("doc_id", "text")))
    return tokens.groupBy("doc_id").agg(
        F.count("*").alias("n_words"),
        F.countDistinct("term").alias("n_distinct"),
        F.sum(F.length("term")).alias("chars"),
        F.min("term").alias("first"),
        F.max("term").alias("last"),
    )


BLANK_SQL = r"""SELECT conv_id, turn, unnest(s) AS term, generate_subscripts(s, 1) - 1 AS pos FROM (
  SELECT conv_id, turn, regexp_split_to_array(regexp_replace(lower(text), '\s+$', ''), '\s') AS s
  FROM conversations)"""


@query("tok2_whitespace_tokenize", BLANK_SQL)
def _(t):
    tokens = whitespace_tokenize(t.conversations.select("conv_id", "turn", "text"))
    return explode_tokens(tokens, position=True).withColumn("pos", F.col("pos").cast("bigint"))


@query("tok2_blank_tokenize", BLANK_SQL)
def _(t):
    tokens = blank_tokenize(t.conversations.select("conv_id", "turn", "text"))
    return explode_tokens(tokens, position=True).withColumn("pos", F.col("pos").cast("bigint"))


# The lexicon is derived from the words: short ones nouns, the rest by first letter.
LEXICON_SQL = """lex AS (
  SELECT DISTINCT term, CASE WHEN length(term) <= 4 THEN 'noun' WHEN term < 'f' THEN 'verb'
    WHEN term < 'p' THEN 'adjective' ELSE 'other' END AS class FROM toks)"""


def lexicon(t):
    term = F.col("term")
    return t.tokens().select("term").distinct().withColumn(
        "class",
        F.when(F.length(term) <= 4, "noun")
        .when(term < "f", "verb")
        .when(term < "p", "adjective")
        .otherwise("other"),
    )


@query(
    "tok3_keep_classes",
    f"""WITH {SQL_TOKENS}, {LEXICON_SQL}
      SELECT group_id, term, count(*) AS n FROM toks
      SEMI JOIN (SELECT term FROM lex WHERE class IN ('noun', 'verb')) USING (term) GROUP BY 1, 2""",
)
def _(t):
    # Every token of a term has its class, so terms are counted first and the look-up has a row per term of a group.
    kept = keep_classes(term_counts(t.tokens(), ["group_id"]), lexicon(t), ["noun", "verb"], ["group_id"])
    return kept.select("group_id", "term", "n")


@query(
    "tok4_explode_tokens",
    f"""SELECT item_id, unnest(s) AS term, generate_subscripts(s, 1) - 1 AS pos FROM (
      SELECT item_id, {DOC_WORDS} AS s FROM benchmark)""",
)
def _(t):
    tokens = tokenize(t.benchmark.select("item_id", "text"))
    return explode_tokens(tokens, position=True).withColumn("pos", F.col("pos").cast("bigint"))


@query("tok5_distinct_tokens", f"SELECT DISTINCT doc_id, unnest({DOC_WORDS}) AS term FROM documents")
def _(t):
    return explode_tokens(distinct_tokens(tokenize(t.documents.select("doc_id", "text"))))


@query(
    "prd1_frequent_terms",
    f"""WITH {SQL_TOKENS} SELECT term, count(*) AS n FROM toks GROUP BY 1
      HAVING count(*) > 3 AND length(term) > 1""",
)
def _(t):
    return frequent_terms(term_counts(t.tokens()))


@query("prd2_adaptive_frequent_terms", f"WITH {SQL_INDEX_VOCABULARY} SELECT group_id, term, n FROM voc")
def _(t):
    return adaptive_frequent_terms(term_counts(t.tokens(), ["group_id"]), doc_count(t.comments()))


@query(
    "prd3_contains",
    """SELECT doc_id, CAST(contains(text, 'er') AS INT) AS one,
      CAST(contains(text, 'er') AND contains(text, 'qu') AS INT) AS two FROM documents""",
)
def _(t):
    text = F.col("text")
    return t.documents.select(
        "doc_id",
        contains_term(text, F.lit("er")).cast("int").alias("one"),
        contains_both(text, F.lit("er"), F.lit("qu")).cast("int").alias("two"),
    )


@query(
    "prd4_drop_thin_rows",
    f"""WITH {SQL_TOKENS}, voc AS (
        SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) - 1 AS idx FROM toks GROUP BY term),
      long AS (SELECT doc_id, idx, count(*)::DOUBLE AS value FROM toks JOIN voc USING (term) GROUP BY 1, 2),
      thick AS (SELECT doc_id FROM long GROUP BY 1
        HAVING sum(length(CAST(idx + 1 AS VARCHAR)) + 1 + length(CAST(CAST(value AS BIGINT) AS VARCHAR)) + 2 + 1) + 2 >= 400)
      SELECT doc_id, CAST(idx AS BIGINT) AS idx, value FROM long SEMI JOIN thick USING (doc_id)""",
)
def _(t):
    from ..operators.vectors import count_vectors
    from ..runtime import materialize

    tokens = t.tokens()
    vocabulary = materialize(build_vocabulary(term_counts(tokens)), "vocabulary")
    long = count_vectors(tokens, vocabulary)
    return drop_thin_rows(long, "doc_id", min_chars=400).withColumn("idx", F.col("idx").cast("bigint"))


@query(
    "prd5_assign_soft",
    """WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE) AS e FROM embeddings),
      q AS (SELECT vec_id, list_transform(e, lambda x: x * 10) AS p FROM p)
      SELECT vec_id, CAST(coalesce(list_position(list_transform(p, lambda x: x >= 0.5), true) - 1, -1) AS INT) AS cluster
      FROM q""",
)
def _(t):
    squares = F.transform("embedding", lambda x: x.cast("double") * x.cast("double") * 10)
    return assign_soft(t.embeddings.select("vec_id", squares.alias("p"))).select("vec_id", "cluster")


@query("key1_assign_doc_id", "SELECT page_id, url, row_number() OVER (ORDER BY url, page_id) - 1 AS pos FROM pages")
def _(t):
    return assign_doc_id(t.pages.select("page_id", "url"), ["url", "page_id"], "pos")


@query(
    "key2_first_occurrence_id",
    "SELECT lang AS group_id, doc_id, min(doc_id) OVER (PARTITION BY lang, text) AS first_id FROM documents",
)
def _(t):
    return first_occurrence_id(t.comments())


@query(
    "ag1_term_counts",
    f"WITH {SQL_TOKENS} SELECT term, count(*) AS n FROM toks GROUP BY 1",
)
def _(t):
    return term_counts(t.tokens())


@query(
    "ag2_build_vocabulary",
    f"""WITH {SQL_TOKENS}, c AS (SELECT term, count(*) AS n FROM toks GROUP BY 1)
      SELECT term, row_number() OVER (ORDER BY n DESC, term) - 1 AS idx, n FROM c WHERE n > 3 AND length(term) > 1""",
)
def _(t):
    return build_vocabulary(frequent_terms(term_counts(t.tokens())))


@query(
    "ag2_group_vocabulary",
    f"""WITH {SQL_INDEX_VOCABULARY} SELECT group_id, term,
      row_number() OVER (PARTITION BY group_id ORDER BY n DESC, term) - 1 AS idx, n FROM voc""",
)
def _(t):
    counts = adaptive_frequent_terms(term_counts(t.tokens(), ["group_id"]), doc_count(t.comments()))
    return build_vocabulary(counts, ["group_id"])


@query("ag3_doc_count", "SELECT conv_id, count(*) AS n_docs FROM conversations GROUP BY 1")
def _(t):
    return doc_count(t.conversations, ["conv_id"])


AFFINITY_SQL = """, c AS (
    SELECT term, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
      CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM rec GROUP BY 1),
  s AS (SELECT term, pos, neg, pos / (pos + neg) AS exact FROM c)
  SELECT term, pos, neg, round(exact, 6) AS share FROM s WHERE """


def _rounded(df):
    return df.withColumn("share", F.round("share", 6))


@query(
    "ag4_word_affinity",
    f"WITH {SQL_LABELLED % ('quality', DOC_WORDS)}{AFFINITY_SQL} pos > 5 AND exact >= 0.6::DOUBLE AND exact <= 1",
)
def _(t):
    return _rounded(word_affinity(t.labelled("quality")))


@query(
    "ag5_group_affinity",
    f"WITH {SQL_LABELLED_ALL % ('toxic', DOC_WORDS)}{AFFINITY_SQL} neg > 5 AND exact >= 0 AND exact <= 0.3::DOUBLE",
)
def _(t):
    return _rounded(group_affinity(t.labelled("toxic")))


@query(
    "ag6_tag_affinity",
    f"WITH {SQL_LABELLED_ALL % ('toxic', DOC_WORDS)}{AFFINITY_SQL} neg > 5 AND exact >= 0 AND exact < 0.4::DOUBLE",
)
def _(t):
    return _rounded(tag_affinity(t.labelled("toxic")))


@query(
    "ag7_two_sided_affinity",
    f"WITH {SQL_LABELLED % ('toxic', DOC_WORDS)}{AFFINITY_SQL} pos < 10 AND neg > 5",
)
def _(t):
    return _rounded(two_sided_affinity(t.labelled("toxic")))


@query(
    "so1_rank_desc",
    f"""WITH {SQL_LABELLED % ('quality', DOC_WORDS)}{AFFINITY_SQL} pos > 5 AND exact >= 0.6::DOUBLE
      ORDER BY exact DESC, term""",
)
def _(t):
    return _rounded(rank_desc(word_affinity(t.labelled("quality")), "share", "term"))


@query(
    "jn7_merge_class_counts",
    f"""WITH {SQL_LABELLED_ALL % ('quality', DOC_WORDS)},
      a AS (SELECT term, count(*) AS pos FROM rec WHERE label = 1 GROUP BY 1),
      b AS (SELECT term, count(*) AS neg FROM rec WHERE label <> 1 GROUP BY 1)
      SELECT term, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg FROM a FULL OUTER JOIN b USING (term)""",
)
def _(t):
    records = t.labelled("quality")
    return class_counts(records.select(F.explode("terms").alias("term"), "label"))


@query(
    "set3_union_terms_of_classes",
    f"""WITH {SQL_LABELLED % ('quality', DOC_WORDS)}
      SELECT term FROM rec WHERE label = 1 UNION SELECT term FROM rec WHERE label = 0""",
)
def _(t):
    records = t.labelled("quality")
    return class_counts(records.select(F.explode("terms").alias("term"), "label")).select("term")


@query(
    "set2_union_vocabularies",
    f"""WITH {SQL_TOKENS}, c AS (SELECT group_id, term, count(*) AS n FROM toks GROUP BY 1, 2),
      lists AS (SELECT dense_rank() OVER (ORDER BY group_id) AS list,
        row_number() OVER (PARTITION BY group_id ORDER BY n DESC, term) AS pos, term, n / 1000 AS weight FROM c),
      u AS (SELECT term, min((list, pos)) AS f, max_by(weight, (list, pos)) AS weight FROM lists GROUP BY 1)
      SELECT term, row_number() OVER (ORDER BY f) - 1 AS idx, round(weight, 6) AS weight FROM u""",
)
def _(t):
    from ..runtime import dense_index, materialize

    counts = term_counts(t.tokens(), ["group_id"])
    order = [F.asc("group_id"), F.desc("n"), F.asc("term")]
    ranked = materialize(dense_index(counts, order, "pos", within=["group_id"]), "ranked")
    languages = sorted(r["group_id"] for r in ranked.select("group_id").distinct().collect())
    lists = [
        ranked.where(F.col("group_id") == lang).select("term", "pos", (F.col("n") / 1000).alias("weight"))
        for lang in languages
    ]
    return union_vocabularies(lists).withColumn("weight", F.round("weight", 6))


@query(
    "src13_skip_done",
    """SELECT conv_id, turn, role FROM conversations
      WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE turn >= 5)""",
)
def _(t):
    done = t.conversations.where(F.col("turn") >= 5)
    return skip_done(t.conversations.select("conv_id", "turn", "role"), done, "conv_id", ["turn"])
