"""Keys of document rows.

Rows that share both doc_id and text are one document: they get the same result, and each
is returned. Rows that share only the doc_id are different documents, told apart by text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"))


def lower_ascii(text: Column) -> Column:
    """A-Z as a-z; other letters stay."""
    return F.translate(text.cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
