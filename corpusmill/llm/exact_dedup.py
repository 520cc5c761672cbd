"""Exact duplicates by a heavy-hitter split.

A Misra-Gries pass over the digests (Spark's ``freqItems``) names every digest that may
hold more than a given share of the rows. Their groups are counted exactly, combined
before the shuffle, and the winners are broadcast: rows of hot groups are decided where
they are read. All other digests are grouped by an ordinary shuffle, in which no group
is larger than that share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import SPACES, column, numbered, thin_rows
from corpusmill.session import materialize

SUPPORT = 1 / 2000


def _best():
    """Longest original first, then smallest id (null last); the row number parts equal rows."""
    return F.min(F.struct(-F.col("chars"), F.col("id").isNull(), F.col("id"), F.col("row"))).alias("best")


def _decided(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("id").alias("doc_id"),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
        "row",
    )


def duplicate_groups(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    support: float = SUPPORT,
    row_column: str | None = None,
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, keep_id, group_size, kept, text_sha256, row``.

    Texts are equal when they agree after their spaces (x20, x09-x0D) are deleted; null
    counts as empty, so null, empty and blank texts form one group. In a group the row
    with the most code points stays, then the smallest id; a null id loses such ties.
    Rows repeated with their id count as rows of the group, of which one stays. An empty
    table gives an empty result. Texts may be of any length: only digests are shuffled.

    ``support`` bounds what is broadcast to ``1 / support`` rows. ``row_column`` names a
    column of distinct numbers if ``df`` has one.
    """
    text = F.coalesce(column(text_column), F.lit(""))
    digests = thin_rows(
        df,
        row_column,
        "digests",
        id=column(id_column),
        digest=F.sha2(F.regexp_replace(text, SPACES, "").cast("binary"), 256),
        chars=F.length(text),
    )
    keyed = digests.withColumn("key", F.xxhash64("digest"))
    frequent = keyed.stat.freqItems(["key"], support).select(F.explode("key_freqItems").alias("key"))
    size = F.count("*").alias("group_size")
    # At most 1 / support keys come out of the sketch, so at most that many groups.
    winners = materialize(
        keyed.join(F.broadcast(frequent), "key").groupBy("digest").agg(size, _best()).filter("group_size > 1"),
        "hot-digests",
    )
    hot = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    cold = rest.join(rest.groupBy("digest").agg(size, _best()), "digest")
    return _decided(hot.unionByName(cold))


def drop_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    stored = numbered(df, "_dedup_row", "dedup-input")
    groups = duplicate_groups(stored, id_column, text_column, row_column="_dedup_row")
    kept = groups.filter("kept").select(F.col("row").alias("_dedup_row"))
    return stored.join(kept, "_dedup_row", "left_semi").drop("_dedup_row")
