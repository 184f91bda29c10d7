"""Versioned sets of tables in one folder: writers commit, readers keep to the version that they opened.

A table is written whole under a name of its own (data/<table>-<random>), which no reader knows until a version names it. A version
is one small file, versions/<number>.json, that says which tables it has and where; it is put in place by a rename that doesn't
replace, so of two writers that want the same number one gets it. The other looks again: if what came between has left alone the
tables that it writes, its commit follows with the next number, else it is an error. A writer that dies leaves folders that no
version names; its next run writes anew, and `swept` removes what no version names. Nothing that a version names ever changes.

Renames are atomic on HDFS and on local disks; a store without such renames needs a file system layer that has them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.zarr import Files

#: Times that a commit looks again after others have come before it.
TRIES = 20


class Conflict(RuntimeError):
    """Another commit has written a table that this one writes too."""


class Snapshots:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.files = spark, Files(spark, folder)

    def versions(self) -> list[int]:
        if not self.files.fs.exists(self.files.at("versions")):
            return []
        return sorted(int(n.removesuffix(".json")) for n in self.files.children("versions") if n.endswith(".json"))

    def latest(self) -> int:
        """0 if there is none."""
        return max(self.versions(), default=0)

    def named(self, version: int | None = None) -> dict[str, str]:
        """The tables of a version (the latest, if none is given) and their places in the folder."""
        version = self.latest() if version is None else version
        if not version:
            return {}
        known = self.files.attributes("versions", f"{version}.json")
        if known is None:
            raise ValueError(f"{self.files.base} has no version {version}")
        return known["tables"]

    def table(self, name: str, version: int | None = None, schema: str | None = None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(f"{self.files.base}/{self.named(version)[name]}")

    def written(self, name: str, df: DataFrame) -> str:
        """Writes a table that no version names yet; where it is."""
        place = f"data/{name}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.files.base}/{place}")
        return place

    def laid_out_at(self, name: str, version: int) -> str:
        """A new place for a copy of a version's table in another layout; copies are no part of a version."""
        return f"layouts/{version}-{name}-{uuid.uuid4().hex}"

    def commit(self, places: dict[str, str], base: int | None = None, allowed: Callable[[dict[str, str]], bool] = lambda now: True) -> int:
        """A version with these tables beside those of the latest, and its number. `base` is the version that the writer has read:
        tables of `places` that are others now than then are a Conflict, and so is a latest version that isn't allowed."""
        seen = self.named(base if base is not None else self.latest())
        for _ in range(TRIES):
            last = self.latest()
            now = self.named(last)
            if wrong := [n for n in places if now.get(n) != seen.get(n)]:
                raise Conflict(f"{', '.join(sorted(wrong))} of {self.files.base} has another version since {base}")
            if not allowed(now):
                raise Conflict(f"{self.files.base} exists: version {last}")
            if self.put(last + 1, now | places):
                return last + 1
            time.sleep(0.05)
        raise Conflict(f"{self.files.base} is written by too many at once")

    def put(self, version: int, tables: dict[str, str]) -> bool:
        """Whether the version's file could be put in place."""
        made, final = f"versions/.{uuid.uuid4().hex}", self.files.at(f"versions/{version}.json")
        self.files.write_json(made, {"version": version, "tables": tables})
        try:
            return not self.files.fs.exists(final) and self.files.fs.rename(self.files.at(made), final)
        finally:
            self.files.fs.delete(self.files.at(made), False)

    def swept(self, keep: int = 1) -> list[str]:
        """Removes all but the last `keep` versions, and the tables that none of those names: only where nobody writes."""
        old, live = self.versions()[:-keep], {p for v in self.versions()[-keep:] for p in self.named(v).values()}
        for v in old:
            self.files.fs.delete(self.files.at(f"versions/{v}.json"), False)
        gone = [f"data/{n}" for n in (self.files.children("data") if self.files.fs.exists(self.files.at("data")) else []) if f"data/{n}" not in live]
        for place in gone:
            self.files.fs.delete(self.files.at(place), True)
        return gone
