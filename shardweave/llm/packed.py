"""Exchanges of packed arrays.

Millions of small integers per task travel as a few binary rows per receiver instead of one
row each. ``route`` names the receiver; Spark shuffles the rows by it as usual.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length as one binary value."""
    return struct.pack("<q", len(arrays[0])) + b"".join(a.tobytes() for a in arrays)


def unpack(value: bytes, dtypes: tuple[str, ...]) -> list[np.ndarray]:
    (n,) = struct.unpack_from("<q", value)
    at, out = 8, []
    for dtype in dtypes:
        kind = np.dtype(dtype)
        out.append(np.frombuffer(value, kind, n, at))
        at += n * kind.itemsize
    return out


def unpack_all(values: list[bytes], dtypes: tuple[str, ...]) -> list[np.ndarray]:
    """The arrays of many packed values, each put together."""
    parts = [unpack(v, dtypes) for v in values]
    if not parts:
        return [np.zeros(0, d) for d in dtypes]
    return [np.concatenate([p[i] for p in parts]) for i in range(len(dtypes))]


def by_route(route: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The rows of each receiver; their order is kept."""
    order = np.argsort(route, kind="stable")
    sorted_route = route[order]
    firsts = np.concatenate(([0], np.flatnonzero(np.diff(sorted_route)) + 1)) \
        if len(route) else np.zeros(0, np.int64)
    bounds = np.append(firsts, len(route))
    for i, first in enumerate(firsts):
        picked = order[first:bounds[i + 1]]
        yield int(sorted_route[first]), [a[picked] for a in arrays]
