"""Positions and running totals over whole tables.

A window without PARTITION BY, or one per source, would sort everything or a hot
source in a single task. Here the order key is cut at explicit quantiles. The
bucket of a row is a pure function of its key, so totals per bucket (one narrow
pass) and running sums inside a bucket (one shuffle) agree even if tasks rerun.
"""

from __future__ import annotations

from functools import reduce
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardweave.functions.arrays import bind

SAMPLE_PER_BUCKET = 16
ROWS_PER_BUCKET = 200_000
MAX_BUCKETS = 65_536
_BUCKET, _TOTAL, _BEFORE = "_bucket", "_bucket_total", "_bucket_before"


def running_total(df: DataFrame, order: list[str], value: str | None = None,
                  within: list[str] | None = None, out: str = "position",
                  buckets: int | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one.

    ``order`` must name a unique key (per ``within`` group); sums restart for each
    group, rows without a group being one too. Without ``value`` rows are counted, which makes ``out`` a 0-based index.
    ``df`` is read a few times, all but once for narrow columns only, so pass a scan
    or a staged table, not the end of a costly plan.
    """
    within = within or []
    amount = F.col(value).cast("long") if value else F.lit(1).cast("long")
    cuts, gaps = _quantiles(df, within, order, buckets)
    # An equality on buckets of timestamps makes Spark infer a filter it cannot place.
    gaps = gaps or any(dict(df.dtypes)[k] == "timestamp" for k in within + order)
    cut = df.withColumn(_BUCKET, _bucket(df, within + order, cuts))
    groups = within + [_BUCKET]

    # At most one row per bucket and group: the window below stays small.
    totals = cut.groupBy(*groups).agg(F.sum(amount).alias(_TOTAL))
    across = Window.partitionBy(*within, F.lit(0)).orderBy(_BUCKET)
    before = totals.select(
        *groups, (F.sum(_TOTAL).over(across) - F.col(_TOTAL)).alias(_BEFORE))

    inside = (Window.partitionBy(*groups).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The join and the window share one exchange on (within, bucket), unless groups are null.
    if gaps:
        before = before.select(*[F.col(f"`{g}`").alias(f"_of_{g}") for g in groups], _BEFORE)
        same = reduce(lambda a, b: a & b, [F.col(f"`{g}`").eqNullSafe(F.col(f"`_of_{g}`")) for g in groups])
    else:
        same = groups
    return (
        cut.join(before, same)
        .withColumn(out, F.col(_BEFORE) + F.sum(amount).over(inside) - amount)
        .select(*df.columns, out)
    )


def _quantiles(df: DataFrame, within: list[str], order: list[str],
               buckets: int | None) -> tuple[list[str], bool]:
    """Cut points of the key, as JSON, and whether any group is null.

    Cut points decide balance only, never results, so a format that rounds them will do.

    Rows whose key hash falls below a threshold are a repeatable uniform sample of a
    chosen size, found by a filter: nothing is sorted but the sample.
    """
    spark = df.sparkSession
    keys = within + order
    missing = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in within], F.lit(False))
    rows, gaps = df.agg(F.count(F.lit(1)), F.count_if(missing)).first()
    if buckets is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = min(MAX_BUCKETS, max(partitions, rows // ROWS_PER_BUCKET))
    buckets = max(1, min(buckets, rows // SAMPLE_PER_BUCKET))
    if buckets == 1:
        return [], bool(gaps)
    wanted = buckets * SAMPLE_PER_BUCKET
    sample = df.select(*keys)
    if rows > 2 * wanted:
        share = F.xxhash64(*keys).bitwiseAND(F.lit(2**62 - 1))
        sample = sample.filter(share < F.lit(2**62 * wanted // rows))
    # The sample has a fixed size, so one task may number it.
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*keys))
    cuts = (sample.withColumn("_place", place)
            .filter(F.col("_place") % SAMPLE_PER_BUCKET == 0).orderBy("_place")
            .select(F.to_json(F.struct(*_plain(df, keys))).alias("point")).collect())
    return list(dict.fromkeys(row.point for row in cuts)), bool(gaps)


def _plain(df: DataFrame, keys: list[str]) -> list[Column]:
    """Keys in types that JSON holds exactly; their order stays."""
    kinds = dict(df.dtypes)
    return [(F.unix_micros(k) if kinds[k] == "timestamp" else F.col(k)).alias(k) for k in keys]


def _bucket(df: DataFrame, keys: list[str], cuts: list[str]) -> Column:
    """Number of cut points at or below the key, found in two levels."""
    if not cuts:
        return F.lit(0)
    # One JSON literal, folded to a constant by the optimizer: thousands of cut
    # points cost one parse, not thousands of expressions.
    key = F.struct(*_plain(df, keys))
    point = df.select(key.alias("key")).dtypes[0][1]
    width = max(1, isqrt(len(cuts)))
    blocks = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    listed = lambda values: "[" + ",".join(values) + "]"
    heads = F.from_json(F.lit(listed([b[0] for b in blocks])), f"array<{point}>")
    tables = F.from_json(F.lit(listed([listed(b) for b in blocks])), f"array<array<{point}>>")

    def at_or_below(values: Column) -> Column:
        return F.size(F.filter(values, lambda p: p <= key))

    found = bind(at_or_below(heads), lambda block: F.when(block == 0, 0).otherwise(
        (block - 1) * width + at_or_below(F.element_at(tables, block))))
    return F.coalesce(found, F.lit(0))
