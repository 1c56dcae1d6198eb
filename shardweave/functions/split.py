"""Train / validation routing by keyed hash."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def check_ratio(ratio: float) -> float:
    if not 0.0 <= ratio < 1.0:
        raise ValueError(f"validation ratio must lie in [0, 1), got {ratio}")
    return ratio


def is_validation(key: Column, ratio: float, digest: str = "sha256") -> Column:
    """True when the 64-bit hash of ``key``, read as a fraction, is below ``ratio``.

    ``sha256`` compares hex strings inside whole-stage codegen. ``blake2b`` uses
    8-byte BLAKE2b digests for splits that must equal earlier ones bit for bit.
    """
    check_ratio(ratio)
    if ratio == 0.0:
        return F.lit(False)
    if digest == "sha256":
        return F.substring(F.sha2(key, 256), 1, 16) < F.lit(f"{int(ratio * 2**64):016x}")
    if digest == "blake2b":
        return _blake_fraction(key) < F.lit(ratio)
    raise ValueError(f"unknown digest: {digest}")


def split_name(key: Column, ratio: float, digest: str = "sha256") -> Column:
    return F.when(is_validation(key, ratio, digest), "val").otherwise("train")


@F.arrow_udf(T.DoubleType())
def _blake_fraction(keys: pa.Array) -> pa.Array:
    return pa.array(
        [None if k is None else
         int.from_bytes(hashlib.blake2b(k.encode(), digest_size=8).digest(), "big") / 2**64
         for k in keys.to_pylist()],
        pa.float64(),
    )
