"""Next-token windows and random batches over packed shards and documents."""

from __future__ import annotations

import bisect
import hashlib
import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardweave.functions.arrays import bind
from shardweave.functions.text import unit_hash
from shardweave.operators.order import running_total
from shardweave.operators.pack import BLOCK_TOKENS, FOLDER, FOLDER_SHARDS, shard_folder

BATCHES_PER_SHARD = 64
#: Requests for blocks that are broadcast at a time.
PLAN_ROWS = 1_000_000
MAX_BATCH = 100_000


def _positive(name: str, value: int) -> int:
    if value <= 0:
        raise ValueError(f"{name} must be positive, got {value}")
    return value


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _pair(tokens: Column, block: int) -> list[Column]:
    return [F.slice(tokens, 1, block).alias("x"), F.slice(tokens, 2, block).alias("y")]


def shard_windows(lengths: DataFrame, block: int) -> DataFrame:
    """Add ``valid_starts``; windows never cross shards."""
    _positive("block", block)
    return lengths.withColumn(
        "valid_starts", F.greatest(F.col("length") - block, F.lit(0)).cast("long"))


def usable_shards(windows: DataFrame) -> DataFrame:
    """Shards with at least one window; none at all is an error."""
    usable = windows.filter("valid_starts > 0")
    if usable.isEmpty():
        raise ValueError("no shard is long enough for one window")
    return usable


def shard_weights(windows: DataFrame) -> DataFrame:
    """Share of all windows of the split held by each usable shard."""
    usable = windows.filter("valid_starts > 0")
    totals = usable.groupBy("split").agg(F.sum("valid_starts").alias("split_starts"))
    return (usable.join(F.broadcast(totals), "split")  # a row per split
            .withColumn("weight", F.col("valid_starts") / F.col("split_starts"))
            .drop("split_starts"))


def long_enough(docs: DataFrame, block: int) -> DataFrame:
    return docs.filter(F.col("n_tokens") >= _positive("block", block) + 1)


def sliding_windows(sequences: DataFrame, block: int) -> DataFrame:
    """Every window of each sequence: ``n - block`` rows, one per start.

    Output is about ``2 * block`` times the input; meant for single sequences.
    """
    n = F.size("ids")
    fits = sequences.filter(n > _positive("block", block))
    starts = fits.withColumn("start", F.explode(F.sequence(F.lit(0), n - block - 1)))
    window = F.slice("ids", F.col("start") + 1, block + 1)
    return starts.withColumn("_w", window).select(
        *sequences.columns, "start", *_pair(F.col("_w"), block)).drop("ids")


def document_window(docs: DataFrame, key: str, block: int, seed: int) -> DataFrame:
    """One window per long enough document, its start drawn by a keyed hash."""
    u = unit_hash(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    start = F.floor(u * (F.size("ids") - block)).cast("int")
    picked = (long_enough(docs, block).withColumn("start", start)
              .withColumn("_w", F.slice("ids", F.col("start") + 1, block + 1)))
    return picked.select(key, "start", *_pair(F.col("_w"), block))


def distinct_starts(valid: Column, batch: int, key: Column) -> Column:
    """``batch`` different numbers below ``valid``, uniform over all such sets.

    Candidate i is drawn below ``valid - batch + i + 1``; a repeat takes that bound's
    last value instead. Exact in ``batch`` steps, so no redraws and no de-duplication.
    """
    def draw(i: Column) -> Column:
        u = unit_hash(F.concat_ws(":", key, i.cast("string")))
        return F.floor(u * (valid - batch + i + 1)).cast("long")

    empty = F.array().cast("array<bigint>")
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(batch - 1)), empty,
        lambda taken, i: bind(draw(i), lambda d: F.array_append(
            taken, F.when(F.array_contains(taken, d), valid - batch + i)
            .otherwise(d).cast("long"))))


def repeated_starts(valid: Column, batch: int, key: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(batch - 1)),
        lambda i: F.floor(
            unit_hash(F.concat_ws(":", key, i.cast("string"))) * valid).cast("long"))


def batch_plan(windows: DataFrame, batches: int, batch: int, seed: int,
               per_shard: int = BATCHES_PER_SHARD) -> DataFrame:
    """``(batch_idx, slot, shard_idx, start)`` for ``batches`` batches of one split.

    A shard is drawn by its share of windows and serves ``per_shard`` batches in a
    row. Starts are drawn without replacement unless the shard has fewer than
    ``batch`` of them. ``windows`` is read several times: pass a staged table.
    """
    _positive("batch", batch), _positive("per_shard", per_shard)
    spark = windows.sparkSession
    usable = usable_shards(windows)
    if usable.select("split").distinct().count() > 1:
        raise ValueError("plan batches for one split at a time")
    total, shards = usable.agg(F.sum("valid_starts"), F.count("*")).first()
    visits = -(-batches // per_shard)

    # Weighted choice: a point on the line of all windows falls into one shard. The
    # line is cut into cells, so the range lookup is an equi-join on the cell.
    cell = F.lit(-(-total // shards)).cast("long")
    line = running_total(usable, ["shard_idx"], "valid_starts", out="low")
    cells = line.withColumn("cell", F.explode(F.sequence(
        _div(F.col("low"), cell), _div(F.col("low") + F.col("valid_starts") - 1, cell))))
    u = unit_hash(F.concat_ws(":", F.lit(f"{seed}:shard"), F.col("visit").cast("string")))
    draws = (spark.range(visits).withColumnRenamed("id", "visit")
             .withColumn("point", F.floor(u * F.lit(total)).cast("long"))
             .withColumn("cell", _div(F.col("point"), cell)))
    chosen = draws.join(cells, "cell").filter(
        (F.col("point") >= F.col("low"))
        & (F.col("point") < F.col("low") + F.col("valid_starts")))

    first = F.col("visit") * per_shard
    last = F.least(first + per_shard, F.lit(batches).cast("long")) - 1
    each = chosen.select("split", "shard_idx", "valid_starts",
                         F.explode(F.sequence(first, last)).alias("batch_idx"))
    key = F.concat_ws(":", F.lit(f"{seed}:start"), F.col("batch_idx").cast("string"))
    starts = F.when(F.col("valid_starts") < batch,
                    repeated_starts(F.col("valid_starts"), batch, key)).otherwise(
        distinct_starts(F.col("valid_starts"), batch, key))
    return each.select("batch_idx", "split", "shard_idx",
                       F.posexplode(starts).alias("slot", "start"))


def batch_windows(plan: DataFrame, pieces: DataFrame, block: int, block_tokens: int = BLOCK_TOKENS,
                  folder_shards: int = FOLDER_SHARDS, plan_rows: int = PLAN_ROWS) -> DataFrame:
    """Tokens ``x`` and ``y`` of every planned window.

    Each window asks for the few blocks it touches and meets their pieces by an
    equi-join. The plan is broadcast, ``plan_rows`` requests at a time, so stored tokens do not
    move; of a table written by ``write_shards`` with ``folder_shards`` only the folders of drawn
    shards are opened.
    """
    step = F.lit(block_tokens).cast("long")
    at = F.col("start")
    batches, rows = plan.agg(F.max("batch_idx"), F.count("*")).first()
    requests = (rows or 0) * (-(-block // block_tokens) + 1)  # the most blocks a window can touch
    parts = max(1, -(-requests // plan_rows))
    each = -(-((batches or 0) + 1) // parts)
    keys = ["split", "shard_idx", "block"]
    stored = pieces.select(*keys, F.col("start").alias("piece_start"), "tokens")
    if FOLDER in pieces.columns:
        keys = ["split", FOLDER, "shard_idx", "block"]
        stored = pieces.select(*keys, F.col("start").alias("piece_start"), "tokens")
    found = None
    for part in range(parts):
        # The comparison tells Spark that the plan chooses among the folders.
        some = plan.filter((F.col("batch_idx") >= part * each) & (F.col("batch_idx") < (part + 1) * each))
        wanted = some.select(
            "batch_idx", "slot", "split", "shard_idx", shard_folder(F.col("shard_idx"), folder_shards).alias(FOLDER),
            at, F.explode(F.sequence(_div(at, step), _div(at + block, step))).alias("block"))
        met = stored.join(F.broadcast(wanted), keys)
        found = met if found is None else found.unionByName(met)
    low = F.greatest(at, F.col("piece_start"))
    high = F.least(at + block + 1, F.col("piece_start") + F.size("tokens"))
    parts = found.filter(low < high).withColumn("part", F.slice(
        "tokens", (low - F.col("piece_start") + 1).cast("int"), (high - low).cast("int")))
    ordered = F.array_sort(F.collect_list(F.struct("piece_start", "part")))
    tokens = F.flatten(F.transform(ordered, lambda p: p["part"]))
    return (parts.groupBy("batch_idx", "slot", "split", "shard_idx", "start")
            .agg(tokens.alias("_w"))
            .select("batch_idx", "slot", "shard_idx", "start", *_pair(F.col("_w"), block)))


def draw_bucket(key: Column) -> Column:
    """The bucket of a key, by hash, so that buckets are of about one size."""
    return F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 4), 16, 10).cast("int")


def _unit(key: str) -> float:
    """``unit_hash`` on the driver."""
    return int(hashlib.sha256(key.encode()).hexdigest()[:13], 16) / 2**52


def uniform_batch(docs: DataFrame, key: str, block: int, batch: int, seed: int) -> DataFrame:
    """One batch drawn with replacement from the long enough documents.

    Documents count in the order of (hash bucket, key), but no document is numbered: counts of the
    buckets tell which bucket a drawn number falls into, and only the keys of drawn buckets are ranked.
    ``batch`` is a parameter of at most ``MAX_BATCH``; the draws are a list of that size.
    """
    if _positive("batch", batch) > MAX_BATCH:
        raise ValueError(f"a batch has at most {MAX_BATCH} slots, got {batch}")
    pool = long_enough(docs, block)
    # At most 65,536 rows, one per bucket.
    counts = sorted((r.bucket, r.n) for r in pool.groupBy(draw_bucket(F.col(key)).alias("bucket")).agg(
        F.count("*").alias("n")).collect())
    ends = list(itertools.accumulate(n for _, n in counts))
    if not ends:
        raise ValueError("no document is long enough for one window")
    slots = []
    for slot in range(batch):
        at = int(_unit(f"{seed}:doc:{slot}") * ends[-1])
        i = bisect.bisect_right(ends, at)
        slots.append((slot, counts[i][0], at - (ends[i] - counts[i][1])))
    spark = docs.sparkSession
    draws = F.broadcast(spark.createDataFrame(slots, "slot long, bucket int, place long"))
    drawn = pool.select(key, draw_bucket(F.col(key)).alias("bucket")).filter(
        F.col("bucket").isin(sorted({b for _, b, _ in slots})))
    ranked = drawn.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy(key)) - 1)
    chosen = ranked.join(draws, ["bucket", "place"]).select("slot", key)
    at = unit_hash(F.concat_ws(":", F.lit(f"{seed}:start"), F.col("slot").cast("string")))
    found = (docs.join(F.broadcast(chosen), key)  # exactly ``batch`` rows
             .withColumn("start", F.floor(at * (F.size("ids") - block)).cast("int"))
             .withColumn("_w", F.slice("ids", F.col("start") + 1, block + 1)))
    return found.select("slot", key, "start", *_pair(F.col("_w"), block))
