"""Column expressions over raw document rows. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text columns in order of preference.
TEXT_COLUMNS = ("text", "content", "document")

# The characters str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def stripped(col: Column) -> Column:
    """Unicode-aware strip; the one-argument trim would only remove U+0020."""
    return F.btrim(col, F.lit(WHITESPACE))


def usable_text(df: DataFrame) -> Column:
    """First candidate column holding non-blank text, stripped, else null.

    Columns of any other type than string never count as text.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    options = [
        F.nullif(stripped(F.col(name)), F.lit(""))
        for name in TEXT_COLUMNS
        if isinstance(types.get(name), T.StringType)
    ]
    return F.coalesce(*options) if options else F.lit(None).cast("string")


def doc_key(source_id: Column, row_id: Column, doc_idx: Column) -> Column:
    """Stable key of a document: its own id where it has one, else its position."""
    return F.concat_ws(":", source_id,
                       F.coalesce(row_id.cast("string"), doc_idx.cast("string")))


def source_key(custom: Column, path: Column, name: Column, split: Column) -> Column:
    """Identifier of a configured source."""
    return F.coalesce(
        F.nullif(stripped(custom), F.lit("")),
        F.concat_ws(":", path, F.nullif(name, F.lit("")), split),
    )


def unit_hash(key: Column) -> Column:
    """A repeatable number in [0, 1) from the first 52 bits of a SHA-256."""
    bits = F.conv(F.substring(F.sha2(key, 256), 1, 13), 16, 10)
    return bits.cast("double") / F.lit(float(2**52))
