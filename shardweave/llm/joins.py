"""Joins of documents with tables of ids that may or may not be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000


def bounded(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``side``, to be broadcast when counting proves it to have at most ``rows`` rows.

    For narrow tables that are already written. Beyond the bound Spark shuffles both sides.
    """
    return F.broadcast(side) if is_bounded(side, rows) else side


def is_bounded(side: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    return side.limit(rows + 1).count() <= rows


def keep_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents whose id is among ``ids``."""
    return docs.join(bounded(ids), key, "left_semi")


def drop_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents whose id is not among ``ids``; a null id is never among them."""
    return docs.join(bounded(ids), key, "left_anti")
