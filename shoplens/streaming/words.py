"""Tumbling-window word count over a text stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_counts(lines: DataFrame, length: str = "3 seconds", time_col: str | None = None,
                watermark: str | None = None) -> DataFrame:
    """Count of each word per tumbling window.  Without ``time_col`` the window
    is on processing time (arrival), as the original micro-batch window was."""
    t = F.col(time_col) if time_col else F.current_timestamp()
    words = lines.select(t.alias("t"), F.explode(F.split(F.col("value"), r"\s+")).alias("word"))
    words = words.where(F.col("word") != "")
    if watermark:
        words = words.withWatermark("t", watermark)
    return (words.groupBy(F.window("t", length).alias("w"), "word")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "word", "n"))
