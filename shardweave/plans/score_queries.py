"""Queries on score tables: ``embeddings`` has a score vector and a target per row."""

from __future__ import annotations

from pyspark.sql import functions as F

from shardweave.operators import scores
from shardweave.plans.corpus import unit_sql
from shardweave.plans.registry import query, table

_SQL_LOSS = """
losses AS (
  SELECT vec_id, label,
         m + ln(list_sum(list_transform(s, lambda v: exp(v - m)))) - s[label + 1] AS loss
  FROM (SELECT vec_id, label, embedding::DOUBLE[] AS s, list_max(embedding::DOUBLE[]) AS m
        FROM embeddings))"""


def _losses(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return rows.select("vec_id", "label", scores.cross_entropy(
        F.col("embedding"), F.col("label")).alias("loss"))


@query(f"WITH {_SQL_LOSS} SELECT vec_id, round(loss, 9) AS loss FROM losses")
def cross_entropy(spark, sf_dir):
    return _losses(spark, sf_dir).select("vec_id", F.round("loss", 9).alias("loss"))


@query(f"""
WITH {_SQL_LOSS}
SELECT label AS step, CASE WHEN vec_id < 250 THEN 'val' ELSE 'train' END AS split,
       round(avg(loss), 9) AS mean_loss
FROM losses GROUP BY ALL""")
def mean_loss(spark, sf_dir):
    logged = _losses(spark, sf_dir).select(
        F.col("label").alias("step"),
        F.when(F.col("vec_id") < 250, "val").otherwise("train").alias("split"), "loss")
    return scores.mean_loss(logged, ["step", "split"]).select(
        "step", "split", F.round("mean_loss", 9).alias("mean_loss"))


@query(f"""
WITH {_SQL_LOSS}
SELECT label, round(avg(loss), 9) AS loss, round(exp(avg(loss)), 6) AS perplexity
FROM losses GROUP BY label""")
def perplexity(spark, sf_dir):
    means = scores.mean_loss(_losses(spark, sf_dir), ["label"])
    return means.select("label", F.round("mean_loss", 9).alias("loss"),
                        F.round(scores.perplexity(F.col("mean_loss")), 6).alias("perplexity"))


# Scores are rounded to one digit here, so ties at the cutoff do occur.
_SQL_TOPK = """
flat AS (
  SELECT vec_id, round(unnest(embedding)::DOUBLE, 1) / 0.8 AS s,
         (generate_subscripts(embedding, 1) - 1)::INTEGER AS token
  FROM embeddings),
ranked AS (SELECT *, rank() OVER (PARTITION BY vec_id ORDER BY s DESC) AS rk,
                  max(s) OVER (PARTITION BY vec_id) AS top FROM flat),
probs AS (
  SELECT vec_id, token, exp(s - top) / sum(exp(s - top)) OVER (PARTITION BY vec_id) AS prob
  FROM ranked WHERE rk <= 5)"""


def _choices(spark, sf_dir):
    rounded = F.transform(F.col("embedding").cast("array<double>"), lambda v: F.round(v, 1))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", rounded.alias("scores"))
    return scores.top_k_probabilities(rows, "vec_id", "scores", temperature=0.8, top_k=5)


@query(f"WITH {_SQL_TOPK} SELECT vec_id, token, round(prob, 9) AS prob FROM probs")
def topk_softmax(spark, sf_dir):
    return _choices(spark, sf_dir).select("vec_id", F.explode("choices").alias("c")).select(
        "vec_id", "c.token", F.round("c.prob", 9).alias("prob"))


@query(f"""
WITH {_SQL_TOPK}, cum AS (
  SELECT vec_id, token, sum(prob) OVER (PARTITION BY vec_id ORDER BY token) AS reached,
         {unit_sql("'3:' || vec_id")} AS u
  FROM probs)
SELECT vec_id, min(token) FILTER (reached > u) AS token FROM cum GROUP BY vec_id""")
def sample_choice(spark, sf_dir):
    return scores.sample_choice(_choices(spark, sf_dir), "vec_id", seed=3)
