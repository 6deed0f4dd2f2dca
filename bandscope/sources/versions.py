"""Versioned folders: tables that change as a whole, or not at all.

A versioned folder holds data folders, written once and never changed, and numbered records. The record
with the highest number is the pointer: it names the data folders of the current version, and what else that version
needs to know. A version is committed by putting its record in place, which is one rename that fails if the number is
taken. So a reader sees the old version or the new one, whole; a write that fails leaves a data folder
that no record names; and of two writers one fails and changes nothing. Old versions can be read
until `vacuum` drops them.

    root/data-<uuid>/...          Parquet
    root/_records/00000007.json   {"version": 7, "data": ["data-..."], "facts": {...}}
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bandscope.sources import files

RECORDS = "_records"
# Records are found by listing; older ones than this many are dropped with their versions by `vacuum`.
KEEP = 10


class Conflict(RuntimeError):
    """Another writer committed the version first; nothing was changed."""


@dataclass(frozen=True)
class Version:
    """One record. `data` are data folders by name, in the order they were added."""

    number: int
    data: tuple[str, ...]
    schema: str
    facts: dict = field(default_factory=dict)


@dataclass(frozen=True)
class VersionedFolder:
    spark: SparkSession
    root: str

    def place(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def numbers(self) -> list[int]:
        """Numbers of the versions that can be read, rising."""
        names = files.listing(self.spark, self.place(RECORDS))
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:8].isdigit()]

    def version(self, number: int | None = None) -> Version | None:
        """A version, the current one by default; None if there is none at all."""
        known = self.numbers()
        if number is None and not known:
            return None
        wanted = known[-1] if number is None else number
        if wanted not in known:
            raise ValueError(f"{self.root}: no version {wanted}; there are {known}")
        told = files.read_json(self.spark, self.place(f"{RECORDS}/{wanted:08d}.json"))
        return Version(told["version"], tuple(told["data"]), told["schema"], told["facts"])

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version, the current one by default."""
        found = self.version(number)
        if found is None:
            raise ValueError(f"{self.root}: nothing has been committed")
        return self.rows_of(found.data, found.schema)

    def rows_of(self, data: Sequence[str], schema: str) -> DataFrame:
        kind = T.StructType.fromJson(json.loads(schema))
        if not data:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(*map(self.place, data))

    def write(self, df: DataFrame, arrange: Callable | None = None) -> str:
        """Write df as a new data folder, which no version names yet. `arrange` may set up its writer."""
        name = f"data-{uuid.uuid4().hex}"
        writer = df.write.mode("errorifexists")
        (arrange(writer) if arrange else writer).parquet(self.place(name))
        return name

    def commit(self, data: Sequence[str], schema: T.StructType, after: Version | None, facts: dict | None = None) -> Version:
        """Make a version of data folders that are there, to follow `after` (the version its maker read)."""
        number = after.number + 1 if after else 1
        # Columns written as Parquet come back nullable.
        loose = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        made = Version(number, tuple(data), loose.json(), facts or {})
        record = {"version": number, "data": list(data), "schema": made.schema, "facts": made.facts}
        try:
            files.write_json(self.spark, self.place(f"{RECORDS}/{number:08d}.json"), record)
        except FileExistsError:
            raise Conflict(f"{self.root}: version {number} was committed by another writer") from None
        return made

    def vacuum(self, keep: int = KEEP) -> list[str]:
        """Drop all but the last `keep` versions, and the data folders that none of the rest names. Returns those.

        Not while a write is on its way: the data of a version not yet committed is named by no record.
        """
        known = self.numbers()
        for number in known[: -max(1, keep)]:
            files.delete(self.spark, self.place(f"{RECORDS}/{number:08d}.json"))
        named = {name for number in known[-max(1, keep) :] for name in self.version(number).data}
        stale = [n for n in files.listing(self.spark, self.root) if n.startswith("data-") and n not in named]
        for name in stale:
            files.delete(self.spark, self.place(name))
        return stale


def publish_version(df: DataFrame, root: str, view: str | None = None) -> Version:
    """Replace the table in a versioned folder by df, and point a catalog view at the new version.

    The rows are written before anything points at them. If the write fails, or another writer was first,
    version and view stay as they were. df may read the version it replaces.
    """
    folder = VersionedFolder(df.sparkSession, root)
    before = folder.version()
    made = folder.commit([folder.write(df)], df.schema, before)
    if view is not None:
        point_view(df.sparkSession, root, view)
    return made


def point_view(spark: SparkSession, root: str, view: str, number: int | None = None) -> DataFrame:
    """Point a catalog view at a version, the current one by default; also after a crash between commit and view."""
    folder = VersionedFolder(spark, root)
    found = folder.version(number)
    paths = " UNION ALL ".join(f"SELECT * FROM parquet.`{folder.place(name)}`" for name in found.data)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {paths}")
    return spark.table(view)
