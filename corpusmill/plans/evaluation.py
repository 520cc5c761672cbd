"""The evaluation report: perplexity, generation records and coherence together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators import quality


def _as_metrics(summary: DataFrame) -> DataFrame:
    """A one-row summary as ``(metric, value)`` rows."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in summary.columns]
    return summary.select(F.inline(F.array(*pairs)))


def report(generation_log: DataFrame, losses: DataFrame | None = None) -> DataFrame:
    """``(metric, value)`` rows; perplexity only when block losses are given."""
    coherence = quality.coherence(quality.score_texts(generation_log, "generated_text"))
    metrics = _as_metrics(quality.generation_summary(generation_log)).unionByName(_as_metrics(coherence))
    if losses is None:
        return metrics
    return metrics.unionByName(_as_metrics(quality.perplexity(losses)))
