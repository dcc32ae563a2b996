"""Sets of tables that change at once: a folder per release, and a marker that makes it the current one.

The tables of a release are written to a folder of their own, and readers follow the marker with the greatest number. A
marker is an empty file that is made last; making a file is atomic on every store, so readers see all tables of a release
or none of them. A run that dies before leaves the release before it in place, and a folder that nobody reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

MARKERS, DATA = "_releases", "_tables"


@dataclass(frozen=True)
class Release:
    number: int
    folder: str

    def path(self, root: str, name: str) -> str:
        return f"{root}/{DATA}/{self.folder}/{name}"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def releases(spark: SparkSession, root: str) -> list[Release]:
    """The releases that are kept, oldest first."""
    place, store = _place(spark, f"{root}/{MARKERS}")
    if not store.exists(place):
        return []
    names = sorted(s.getPath().getName() for s in store.listStatus(place))
    return [Release(int(name.split("-")[0]), name) for name in names]


def publish(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], keep: int = 3) -> Release:
    """Writes all ``tables`` and makes them the current ones together.

    ``keep`` releases stay, so that queries that began on an earlier one can end. Of two runs that publish at the same
    time, one is current as a whole.
    """
    kept = releases(spark, root)
    number = kept[-1].number + 1 if kept else 1
    fresh = Release(number, f"{number:010d}-{uuid.uuid4().hex}")
    for name, df in tables.items():
        df.write.parquet(fresh.path(root, name))
    place, store = _place(spark, f"{root}/{MARKERS}/{fresh.folder}")
    store.create(place, False).close()
    for old in kept[: max(0, len(kept) + 1 - keep)]:
        for gone in (f"{root}/{MARKERS}/{old.folder}", f"{root}/{DATA}/{old.folder}"):
            place, store = _place(spark, gone)
            store.delete(place, True)
    return fresh


def published(spark: SparkSession, root: str, name: str, release: Release | None = None) -> DataFrame:
    """A table of the current release. For several tables of one state, pass the same ``release`` to each call."""
    if release is None:
        kept = releases(spark, root)
        if not kept:
            raise FileNotFoundError(f"nothing is published below {root}")
        release = kept[-1]
    return spark.read.parquet(release.path(root, name))


def rollback(spark: SparkSession, root: str) -> Release:
    """Takes the current release back; the one before it is current again."""
    kept = releases(spark, root)
    if len(kept) < 2:
        raise ValueError(f"no earlier release below {root}")
    place, store = _place(spark, f"{root}/{MARKERS}/{kept[-1].folder}")
    store.delete(place, False)
    return kept[-2]
