"""Where the files of a configured source lie: its ``name`` and ``split`` under its path.

A name or split is a folder of that name, a partition folder (``name=...``, ``split=...``), or, for
splits, files whose names start with it (``train-00000.parquet``). A path without any such layout is
read as a whole, its split being a mere label.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Splits by which a divided folder is known.
USUAL_SPLITS = ("train", "validation", "val", "valid", "dev", "test")


class Storage:
    """Existence checks on any storage Spark can reach."""

    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def any(self, pattern: str) -> bool:
        path = self._path(pattern)
        found = path.getFileSystem(self._conf).globStatus(path)
        return found is not None and len(found) > 0

    def folder(self, path: str) -> bool:
        at = self._path(path)
        storage = at.getFileSystem(self._conf)
        return storage.exists(at) and storage.getFileStatus(at).isDirectory()


def _escaped(name: str) -> str:
    """``name`` as a glob pattern that matches only itself."""
    return "".join("\\" + c if c in "\\*?[]{}" else c for c in name)


def _inside(storage: Storage, path: str, key: str, value: str) -> str | None:
    for folder in (f"{path}/{value}", f"{path}/{key}={value}"):
        if storage.folder(folder):
            return folder
    return None


def source_path(spark: SparkSession, entry: dict) -> str:
    """The folder, file or file pattern that holds the entry's rows.

    A path that is divided by names or splits but lacks the wanted one is an error.
    """
    path, storage = entry["path"].rstrip("/"), Storage(spark)
    if not storage.folder(path):
        return path
    name, split = entry.get("name"), entry["split"]
    if name:
        inner = _inside(storage, path, "name", name)
        if inner is None and storage.any(f"{_escaped(path)}/name=*"):
            raise ValueError(f"{path} has no {name!r}")
        path = inner or path
    if not split:
        return path
    for base in (path, f"{path}/data"):
        inner = _inside(storage, base, "split", split)
        if inner is not None:
            return inner
        files = f"{_escaped(base)}/{_escaped(split)}[-._]*"
        if storage.any(files):
            return files
    others = [f"{_escaped(path)}/split=*"] + [
        f"{_escaped(base)}/{usual}{end}" for base in (path, f"{path}/data") for usual in USUAL_SPLITS
        for end in ("", "[-.]*")]
    if any(storage.any(pattern) for pattern in others):
        raise ValueError(f"{path} has no split {split!r}")
    return path
