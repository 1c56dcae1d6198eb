"""All texts of a source joined by newlines, as fixed-size parts.

One string per source would have to fit one row of one task. The joined string is
instead cut every ``part_chars`` characters; parts in order spell it exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardweave.operators.order import running_total


def joined_parts(docs: DataFrame, key: str, part_chars: int = 65_536) -> DataFrame:
    """``(source_id, part, text)`` for ``docs(source_id, key, text)``."""
    spans = docs.select("source_id", key, "text",
                        (F.length("text") + 1).cast("long").alias("span"))
    placed = running_total(spans, [key], "span", ["source_id"], "offset")
    ends = (docs.groupBy("source_id")
            .agg(F.sum((F.length("text") + 1).cast("long")).alias("whole")))
    # The last document of a source gets no newline after it.
    line = F.when(F.col("offset") + F.col("span") == F.col("whole"), F.col("text")).otherwise(
        F.concat("text", F.lit("\n")))
    size = F.lit(part_chars).cast("long")
    div = lambda a: F.call_function("div", a, size)
    cut = (placed.join(ends, "source_id").select("source_id", "offset", line.alias("line"))
           .filter("line <> ''")
           .select("*", F.explode(F.sequence(
               div(F.col("offset")),
               div(F.col("offset") + F.length("line") - 1))).alias("part")))
    low = F.greatest(F.col("part") * size - F.col("offset"), F.lit(0).cast("long"))
    high = F.least((F.col("part") + 1) * size - F.col("offset"), F.length("line").cast("long"))
    pieces = cut.select(
        "source_id", "part", "offset",
        F.substring("line", (low + 1).cast("int"), (high - low).cast("int")).alias("piece"))
    # A part holds at most part_chars characters, so this grouping stays small.
    ordered = F.array_sort(F.collect_list(F.struct("offset", "piece")))
    return pieces.groupBy("source_id", "part").agg(
        F.array_join(F.transform(ordered, lambda p: p["piece"]), "").alias("text"))
