"""Files outside Spark's own formats, on any storage Arrow knows."""

from __future__ import annotations

import threading
import time
import weakref

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource

REGISTER_TRIES = 3
_registering = threading.Lock()
_registered: weakref.WeakKeyDictionary[SparkSession, set[str]] = weakref.WeakKeyDictionary()


def register_once(spark: SparkSession, source: type[DataSource]) -> None:
    """Register a Python data source at its first use in a session, one thread at a time.

    Spark first looks for a class of that name, and reports every failure of this search, passing ones
    too, as a source that exists already. So it is asked once, and then again a few times if it says so.
    """
    with _registering:
        known = _registered.setdefault(spark, set())
        for left in range(REGISTER_TRIES - 1, -1, -1):
            if source.name() in known:
                return
            try:
                spark.dataSource.register(source)
                known.add(source.name())
            except AnalysisException as error:
                if error.getCondition() != "DATA_SOURCE_ALREADY_EXISTS" or not left:
                    raise
                time.sleep(1)



def in_groups(items: list, sizes: list[int], each: int) -> list[list]:
    """Consecutive items in groups, each closed by the item that brings it to ``each``."""
    groups, left = [], 0
    for item, size in zip(items, sizes):
        if left <= 0:
            groups.append([])
            left = each
        groups[-1].append(item)
        left -= size
    return groups


def storage_of(path: str):
    """Arrow's file system for a path or URI, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)
