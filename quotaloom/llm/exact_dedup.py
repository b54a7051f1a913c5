"""Exact deduplication by skew-safe combining.

Equal texts are those identical after deleting ASCII white space. They are combined in three
stages, each of which groups by the digest *and* the full normalised text: the map-side half of
the first aggregate deduplicates locally, its reduce side merges salted digest groups, and the
second aggregate combines the salt winners globally. So no task ever sees more of a hot group
than one salt's rows, and after the first stage only one row per salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotaloom.llm.common import SPACE, cut, fresh, lookup, text_of

#: Salts a digest group is cut into.
SALTS = 32
#: A winner is kept as one decimal, n_chars * STEP + (NO_ID - doc_id): larger is better, and it fits a hash aggregate.
STEP = "CAST(36893488147419103232 AS DECIMAL(20,0))"
NO_ID = "CAST(9223372036854775808 AS DECIMAL(20,0))"


def _content(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, "")


def _rank(id_value: Column, n_chars: Column) -> Column:
    """Larger is better: more characters, then a smaller id; a null id comes last."""
    behind = F.expr(NO_ID) - F.coalesce(id_value.cast("decimal(19,0)"), F.expr(NO_ID))
    return (n_chars.cast("decimal(10,0)") * F.expr(STEP) + behind).cast("decimal(38,0)")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("t"))
    rows = rows.select("id", F.char_length("t").alias("n_chars"), _content(F.col("t")).alias("content"))
    return rows.select(
        "id",
        "content",
        F.sha2("content", 256).alias("digest"),
        _rank(F.col("id"), F.col("n_chars")).alias("rank"),
        F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"),
    )


def _groups(keyed: DataFrame) -> DataFrame:
    """One row per distinct content: digest, content, best rank, number of rows."""
    salted = keyed.groupBy("digest", "salt", "content").agg(F.max("rank").alias("best"), F.count(F.lit(1)).alias("n"))
    return salted.groupBy("digest", "content").agg(F.max("best").alias("best"), F.sum("n").alias("group_size"))


def find_exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in the original text, then the smallest id,
    stays. Null text counts as empty; empty texts are equal to each other and to texts of white
    space. A null id loses to any other id; ``keep_id`` is null where only null ids compete. Rows that
    repeat both id and length tie: each is returned, one of them kept. An empty table gives no rows.
    Other columns are ignored.
    """
    keyed = _keyed(docs, id_col, text_col)
    full = _groups(keyed)
    groups = cut(full.select("digest", F.xxhash64("content").alias("check"), "best", "group_size"))
    on = ["digest"]
    if not groups.groupBy("digest").count().where("count > 1").isEmpty():
        on, groups = ["digest", "content"], full  # one digest for several contents: join on the content as well
    rows = keyed.groupBy(*on, "id", "rank").agg(F.count(F.lit(1)).alias("copies"))
    found = lookup(rows, groups, on, "group_size", ["id", "rank"])
    found = found.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    keep = F.expr(f"{NO_ID} - best % {STEP}")
    return found.select(
        "id",
        F.when(keep != F.expr(NO_ID), keep).cast("long").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        ((F.col("rank") == F.col("best")) & (F.col("copy") == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rules as in ``find_exact_groups``.

    Rows are matched to the winners by digest and rank, which differ between the rows of a group,
    so a hot group stays spread; repeated rows are combined locally before that.
    """
    digest, rank = fresh(docs, "_digest", "_rank")
    winners = _groups(_keyed(docs, id_col, text_col)).select(F.col("digest").alias(digest), F.col("best").alias(rank))
    t = text_of(text_col)
    marked = docs.withColumns({digest: F.sha2(_content(t), 256), rank: _rank(F.col(id_col).cast("long"), F.char_length(t))})
    kept = marked.join(winners, [digest, rank], "left_semi")
    return kept.dropDuplicates([digest, rank]).drop(digest, rank)
