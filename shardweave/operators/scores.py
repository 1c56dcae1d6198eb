"""Metrics and sampling over score tables ``(id, scores, target)``.

Each row holds its whole score vector, so everything happens inside the row: no
explode, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardweave.functions.arrays import bind, total
from shardweave.functions.text import unit_hash


def cross_entropy(scores: Column, target: Column) -> Column:
    """logsumexp(scores) - scores[target] of one row; targets count from 0."""
    values = scores.cast("array<double>")
    spread = bind(F.array_max(values), lambda top: top + F.ln(
        total(F.transform(values, lambda v: F.exp(v - top)))))
    return spread - F.element_at(values, target + 1)


def mean_loss(losses: DataFrame, groups: list[str]) -> DataFrame:
    return losses.groupBy(*groups).agg(F.avg("loss").alias("mean_loss"))


def perplexity(loss: Column) -> Column:
    """exp of a mean loss; overflows to infinity."""
    return F.exp(loss)


def top_k_probabilities(df: DataFrame, key: str, scores: str, temperature: float = 1.0,
                        top_k: int | None = None) -> DataFrame:
    """``(key, choices)``: choices are (token, prob) after temperature and top-k.

    Scores equal to the k-th best all stay, so more than k tokens can survive.
    """
    scaled = F.transform(F.col(scores).cast("array<double>"),
                         lambda v: v / F.lit(max(temperature, 1e-6)))

    def survivors(values: Column) -> Column:
        numbered = F.transform(values, lambda v, i: F.struct(
            i.alias("token"), v.alias("score")))
        if top_k is None:
            return numbered
        rank = F.least(F.lit(top_k), F.size(values))
        return bind(F.element_at(F.sort_array(values, asc=False), rank),
                    lambda cutoff: F.filter(numbered, lambda p: p["score"] >= cutoff))

    def softmax(kept: Column) -> Column:
        weights = bind(F.array_max(F.transform(kept, lambda p: p["score"])),
                       lambda top: F.transform(kept, lambda p: F.exp(p["score"] - top)))
        return bind(weights, lambda ws: bind(total(ws), lambda whole: F.zip_with(
            kept, ws, lambda p, w: F.struct(
                p["token"].alias("token"), (w / whole).alias("prob")))))

    return df.select(key, bind(bind(scaled, survivors), softmax).alias("choices"))


def sample_choice(probabilities: DataFrame, key: str, seed: int) -> DataFrame:
    """One draw per row: the first token whose cumulative probability exceeds u."""
    u = unit_hash(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    df = probabilities.withColumn("u", u)
    empty = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("int").alias("token"))

    def step(state: Column, choice: Column) -> Column:
        reached = state["sum"] + choice["prob"]
        hit = state["token"].isNull() & (reached > F.col("u"))
        return F.struct(reached.alias("sum"),
                        F.when(hit, choice["token"]).otherwise(state["token"]).alias("token"))

    drawn = F.aggregate("choices", empty, step, lambda state: state["token"])
    # Rounding can leave the last sum just below 1.
    last = F.element_at("choices", -1)["token"]
    return df.select(key, F.coalesce(drawn, last).alias("token"))
