"""Which folders make up the tables of a store: versions that are published whole.

A run never writes into a folder that a reader may hold. It writes every table, or every piece of a
table that it replaces, into a fresh folder, and at the end one small manifest that names the
folder of each piece of each table. Until that file is there readers see the store as it was, all
tables of it; from then on they see all that the run has made. A run that breaks off leaves folders that
no manifest names.

A piece is a value of the column by which the table is stored (``event_date=2024-01-31``), or
empty for a table that is written whole. The manifest has a line per table and piece, so it grows
with days, months and buckets, not with rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from forgelake.schemas import ddl
from forgelake.sources.lake import folders_in, hadoop_path, no_rows

#: Versions whose folders are kept for readers: the current one and those that runs have just replaced.
KEPT_VERSIONS = 3

MANIFESTS = "_manifest"


class Snapshot:
    """One version of a store: ``parts[table][piece]`` is a folder below ``root``.

    ``marks`` are what a writer wants to be true of exactly this version, such as the last batch in it.
    """

    def __init__(self, spark: SparkSession, root: str, version: int, parts: dict[str, dict[str, str]], marks: dict[str, int]):
        self.spark, self.root, self.version, self.parts, self.marks = spark, root, version, parts, marks

    def pieces(self, table: str) -> dict[str, str]:
        if table not in self.parts:
            raise ValueError(f"{self.root}/{table} has not been written")
        return self.parts[table]

    def read(self, table: str, columns: dict[str, str], pieces: Iterable[str] | None = None) -> DataFrame:
        """The table under the given columns, or those pieces of it that there are.

        Only the folders of these pieces are listed; with no piece there are no rows.
        """
        found = self.pieces(table)
        wanted = list(found) if pieces is None else [p for p in dict.fromkeys(pieces) if p in found]
        if not wanted:
            return no_rows(self.spark, ddl(columns))
        reader = self.spark.read.schema(ddl(columns)).option("basePath", f"{self.root}/{table}")
        return reader.parquet(*[f"{self.root}/{found[p]}" for p in wanted]).select(*columns)

    def folders(self) -> set[str]:
        return {folder for pieces in self.parts.values() for folder in pieces.values()}


def _versions(spark: SparkSession, root: str) -> dict[int, str]:
    files, folder = hadoop_path(spark, f"{root}/{MANIFESTS}")
    if not files.exists(folder):
        return {}
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return {int(n.removesuffix(".json")): n for n in names if n.endswith(".json") and n[0].isdigit()}


def _read(spark: SparkSession, root: str, version: int, name: str) -> Snapshot:
    files, path = hadoop_path(spark, f"{root}/{MANIFESTS}/{name}")
    stream = files.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    content = json.loads(text)
    return Snapshot(spark, root, version, content["parts"], content["marks"])


def snapshot(spark: SparkSession, root: str) -> Snapshot:
    """The newest version; version 0 without tables if nothing has been published."""
    versions = _versions(spark, root)
    if not versions:
        return Snapshot(spark, root, 0, {}, {})
    newest = max(versions)
    return _read(spark, root, newest, versions[newest])


class Run(Snapshot):
    """The next version in the making. What has been put reads like a snapshot before it is published."""

    def __init__(self, spark: SparkSession, root: str):
        before = snapshot(spark, root)
        parts = {t: dict(p) for t, p in before.parts.items()}
        super().__init__(spark, root, before.version + 1, parts, dict(before.marks))
        # a name of its own, so that a run never meets what a broken one has left
        self.name = f"run={self.version:06d}-{uuid.uuid4().hex[:8]}"

    def folder(self, table: str, into: str = "") -> str:
        return f"{self.root}/{table}/{self.name}{into and '-' + into}"

    def put(
        self,
        table: str,
        rows: DataFrame,
        by: tuple[str, ...] = (),
        replaces: Iterable[str] | None = None,
        sort_by: tuple[str, ...] = (),
        balance: bool = True,
        suffix: str = "",
        into: str = "",
        **options: str,
    ) -> None:
        """Make the rows the content of the pieces that are replaced, or of the whole table.

        The first column of ``by`` makes the pieces. ``replaces`` lists pieces; those that get no rows
        are gone, and others stay in the folders where they are. With a ``suffix`` the new pieces are
        called by it (``event_date=2024-01-31/12``) and so stand beside others of the same value. A run
        that puts a table twice names another folder by ``into``.
        """
        if balance and by:
            rows = rows.hint("rebalance", *by)
        if sort_by:
            rows = rows.sortWithinPartitions(*by, *sort_by)
        writer = rows.write.options(**options)
        writer = writer.partitionBy(*by) if by else writer
        home = self.folder(table, into)
        writer.parquet(home)
        if by:
            new = [p for p in folders_in(self.spark, home) if p.startswith(f"{by[0]}=")]
        else:
            new = [""]
        kept = {} if replaces is None else dict(self.parts.get(table, {}))
        for piece in replaces or ():
            kept.pop(piece, None)
        below = home.removeprefix(f"{self.root}/")
        kept.update({p + suffix: f"{below}/{p}".rstrip("/") for p in new})
        self.parts[table] = kept

    def latest(self, table: str, into: str = "") -> list[str]:
        """The pieces that this run has put."""
        below = self.folder(table, into).removeprefix(f"{self.root}/")
        return [p for p, f in self.parts.get(table, {}).items() if f == below or f.startswith(f"{below}/")]

    def drop(self, table: str, pieces: Iterable[str]) -> None:
        for piece in pieces:
            self.parts.get(table, {}).pop(piece, None)

    def publish(self, keep: int = KEPT_VERSIONS) -> Snapshot:
        """Make this version the one that readers get, and clear away what none of the last ``keep`` names.

        One run at a time may change a store: if another has published meanwhile, this one stops.
        """
        target = f"{self.root}/{MANIFESTS}/{self.version:012d}.json"
        files, path = hadoop_path(self.spark, target)
        if files.exists(path):
            raise RuntimeError(f"another run has published version {self.version} of {self.root}")
        started = hadoop_path(self.spark, f"{self.root}/{MANIFESTS}/_{self.name}")[1]
        stream = files.create(started, True)
        text = json.dumps({"parts": self.parts, "marks": self.marks}, sort_keys=True, indent=0)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not files.rename(started, path):
            raise RuntimeError(f"another run has published version {self.version} of {self.root}")
        self._clear(keep)
        return Snapshot(self.spark, self.root, self.version, self.parts, self.marks)

    def _clear(self, keep: int) -> None:
        versions = _versions(self.spark, self.root)
        order = sorted(versions)
        kept = [_read(self.spark, self.root, v, versions[v]) for v in order[-keep:]]
        named = set().union(*[s.folders() for s in kept])
        for old in order[:-keep]:
            files, path = hadoop_path(self.spark, f"{self.root}/{MANIFESTS}/{versions[old]}")
            files.delete(path, False)
        for table, home in folders_in(self.spark, self.root).items():
            for run, folder in folders_in(self.spark, home).items():
                if not run.startswith("run="):
                    continue
                files, path = hadoop_path(self.spark, folder)
                below = f"{table}/{run}"
                if below in named:
                    continue
                used = {f for f in named if f.startswith(f"{below}/")}
                if not used:
                    files.delete(path, True)
                    continue
                for piece, inner in folders_in(self.spark, folder).items():
                    if f"{below}/{piece}" not in used:
                        files.delete(hadoop_path(self.spark, inner)[1], True)
