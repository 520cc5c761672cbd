"""Tables and element lists as documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.binding import whole_part

_MODES = ("single", "elements", "paged")


def table_documents(df: DataFrame, content_column: str = "text") -> DataFrame:
    """``(page_content, metadata)``: one column is the content, all others metadata."""
    if not isinstance(df, DataFrame):
        raise ValueError(f"expected a DataFrame, got {type(df)}")
    if content_column not in df.columns:
        raise ValueError(f"content column {content_column!r} not found in {df.columns}")
    others = [c for c in df.columns if c != content_column]
    entries = [x for c in others for x in (F.lit(c), F.col(c).cast("string"))]
    return df.select(
        F.col(content_column).alias("page_content"),
        F.create_map(*entries).cast("map<string,string>").alias("metadata"),
    )


def element_documents(
    elements: DataFrame,
    mode: str = "single",
    post_processors: Sequence[Callable[[Column], Column]] = (),
    run: int = 4096,
) -> DataFrame:
    """Documents from ``elements(source, seq, page_number, category, element_id, text)``.

    ``elements`` keeps each element; ``paged`` joins the elements of a page, each
    followed by a blank line; ``single`` joins a whole source with blank lines.

    ``seq`` numbers the elements of a source. Elements are joined in runs of ``run``
    numbers and the runs then in order, so the elements of a source or page are joined by many
    tasks and only whole runs meet in the last one. A document is one row: Spark fails on
    one beyond its limit of 2 GB for a value.
    """
    if mode not in _MODES:
        raise ValueError(f"mode must be one of {_MODES}, got {mode!r}")
    text = F.col("text")
    for process in post_processors:
        text = process(text)
    elements = elements.withColumn("text", text)
    if mode == "elements":
        entries = F.map_filter(
            F.create_map(
                F.lit("category"), F.col("category"),
                F.lit("element_id"), F.col("element_id"),
                F.lit("page_number"), F.col("page_number").cast("string"),
            ),
            lambda _, v: v.isNotNull(),
        )
        return elements.select(
            "source", F.col("seq").cast("bigint").alias("seq"),
            F.col("text").alias("page_content"), entries.alias("metadata"),
        )

    keys = ["source"]
    if mode == "paged":
        elements = elements.withColumn("page_number", F.coalesce("page_number", F.lit(1)))
        keys.append("page_number")
    numbered = elements.withColumn("run", whole_part(F.col("seq"), run))
    joined_runs = numbered.groupBy(*keys, "run").agg(
        _joined("seq").alias("text"),
        F.count("*").alias("n_elements"),
        *[F.max(F.when(F.col(c).isNotNull(), F.struct("seq", c))).alias(c) for c in ("category", "element_id")],
    )
    documents = joined_runs.groupBy(*keys).agg(
        _joined("run").alias("page_content"),
        F.sum("n_elements").alias("n_elements"),
        F.max("category")["category"].alias("last_category"),
        F.max("element_id")["element_id"].alias("last_element_id"),
    )
    if mode == "paged":  # a page ends with a blank line
        return documents.withColumn("page_content", F.concat("page_content", F.lit("\n\n")))
    return documents.drop("last_category", "last_element_id")


def _joined(order: str) -> Column:
    pieces = F.array_sort(F.collect_list(F.struct(order, "text")))
    return F.array_join(F.transform(pieces, lambda p: p["text"]), "\n\n")
