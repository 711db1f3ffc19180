"""Tables whose folders are named by a manifest.

Every write goes to a folder of its own, ``stream=<name>/batch_id=<n>/ym=<month>``.
Readers see what the newest manifest lists, so that a set of folders is
replaced by another in one step: the next manifest is written beside the
others and renamed to its number. A write that fails before has changed
nothing that is read. Tables of statistics that belong to the same rows lie in
sub-folders and are switched by the same manifest.

One writer at a time; readers never wait. Folders that no manifest lists any
more are removed by ``remove_unlisted``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from ..functions.settle import delete_path

MANIFESTS = "_manifest"


@dataclass(frozen=True)
class Part:
    """The months that are read from the folder of one write."""

    stream: str
    batch: int
    months: tuple[str, ...]

    @property
    def folder(self) -> str:
        return f"stream={self.stream}/batch_id={self.batch}"


@dataclass(frozen=True)
class Snapshot:
    """What a manifest lists; version 0 is the empty table."""

    version: int = 0
    parts: tuple[Part, ...] = ()

    def with_part(self, part: Part) -> Snapshot:
        """The next version with ``part`` in place of an earlier write of the same name."""
        others = [p for p in self.parts if (p.stream, p.batch) != (part.stream, part.batch)]
        return Snapshot(self.version + 1, (*others, *([part] if part.months else [])))

    def replacing(self, months: Iterable[str], part: Part) -> Snapshot:
        """The next version in which ``part`` alone holds ``months``."""
        gone = set(months)
        left = (replace(p, months=tuple(m for m in p.months if m not in gone)) for p in self.parts)
        return Snapshot(self.version + 1, (*(p for p in left if p.months), part))

    def parts_of(self) -> dict[str, int]:
        """Number of parts that hold each month."""
        counts: dict[str, int] = {}
        for part in self.parts:
            for month in part.months:
                counts[month] = counts.get(month, 0) + 1
        return counts


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; empty if there is none."""
    files, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def written_months(spark: SparkSession, folder: str) -> tuple[str, ...]:
    return tuple(n.removeprefix("ym=") for n in folder_names(spark, folder) if n.startswith("ym="))


def current(spark: SparkSession, target: str) -> Snapshot:
    """The newest manifest of a table."""
    names = [n for n in folder_names(spark, f"{target}/{MANIFESTS}") if n.endswith(".json")]
    if not names:
        return Snapshot()
    text = spark.read.text(f"{target}/{MANIFESTS}/{names[-1]}", wholetext=True).first()[0]
    return Snapshot(int(names[-1].removesuffix(".json")), tuple(Part(s, b, tuple(m)) for s, b, m in json.loads(text)["parts"]))


def commit(spark: SparkSession, target: str, snapshot: Snapshot) -> None:
    """Make ``snapshot`` the current one; fails if another writer has taken its version."""
    files, _ = _at(spark, target)
    path = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{MANIFESTS}/{name}")
    draft, named = path(f".{uuid.uuid4().hex}"), path(f"{snapshot.version:010d}.json")
    out = files.create(draft, True)
    try:
        out.write(bytearray(json.dumps({"parts": [[p.stream, p.batch, list(p.months)] for p in snapshot.parts]}).encode()))
    finally:
        out.close()
    if files.exists(named) or not files.rename(draft, named):
        files.delete(draft, False)
        raise RuntimeError(f"version {snapshot.version} of {target} was committed by another writer")


def read(spark: SparkSession, target: str, snapshot: Snapshot, table: str = "", first: str | None = None, last: str | None = None,
         without: tuple[str, int] | None = None) -> DataFrame | None:
    """The rows that a snapshot lists, of the months from ``first`` to ``last``; None if there are no folders.

    Only folders of these months are listed and opened. ``without`` leaves out one write.
    """
    base = f"{target}/{table}" if table else target
    folders = [
        f"{base}/{p.folder}/ym={m}" for p in snapshot.parts if (p.stream, p.batch) != without
        for m in p.months if (first is None or m >= first) and (last is None or m <= last)
    ]
    return spark.read.option("basePath", base).parquet(*folders) if folders else None


def remove_unlisted(spark: SparkSession, target: str, tables: tuple[str, ...] = ("",)) -> list[str]:
    """Delete month folders that the current manifest doesn't list; returns their paths.

    To be run when no reader of an older manifest and no writer is at work.
    """
    listed = {f"{p.folder}/ym={m}" for p in current(spark, target).parts for m in p.months}
    removed = []
    for table in tables:
        base = f"{target}/{table}" if table else target
        for stream in (n for n in folder_names(spark, base) if n.startswith("stream=")):
            for batch in folder_names(spark, f"{base}/{stream}"):
                for month in (n for n in folder_names(spark, f"{base}/{stream}/{batch}") if n.startswith("ym=")):
                    if f"{stream}/{batch}/{month}" not in listed:
                        removed.append(f"{base}/{stream}/{batch}/{month}")
    for path in removed:
        delete_path(spark, path)
    return removed
