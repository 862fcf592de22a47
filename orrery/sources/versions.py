"""Tables published as whole versions, partition by partition.

A version writes only the partitions it changes, each under a folder of its own, and then
one manifest: for every partition the folder that holds its rows. The manifest is renamed
into place last, so readers see the version before or the version after and nothing in
between, whatever fails in the middle. Folders that no kept manifest names are removed by
``vacuum``. The manifest grows with the number of partitions, not with the rows.

One writer at a time; a second one that publishes the same number fails. Streams pass their
batch id as ``label``, so a replayed batch finds it and publishes nothing twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART, VERSION = "table_part", "table_version"  # folder names; rows must not have columns of these names


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ folders and manifests

    def _names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def _numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self._names(f"{self.root}/manifest") if n.endswith(".json") and n[:-5].isdigit()]

    def _manifest(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{self.root}/manifest/{number:010d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def head(self) -> dict | None:
        """The last manifest: ``number``, ``label`` and ``parts`` (partition folder -> version folder)."""
        numbers = self._numbers()
        return self._manifest(numbers[-1]) if numbers else None

    def _commit(self, manifest: dict) -> None:
        final = self._path(f"{self.root}/manifest/{manifest['number']:010d}.json")
        draft = self._path(f"{self.root}/manifest/.{manifest['number']:010d}-{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise RuntimeError(f"version {manifest['number']} of {self.root} was published by another writer")

    # ------------------------------------------------------------ reading

    def read(self, values: Iterable | None = None, number: int | None = None) -> DataFrame | None:
        """The rows of a version (the last one), of some partitions if ``values`` are given: only their folders are
        listed and read. None where nothing is published or no partition is asked for."""
        manifest = self.head() if number is None else self._manifest(number)
        if manifest is None:
            return None
        wanted = None if values is None else {self._folder(v) for v in values}
        paths = [f"{self.root}/data/{v}/{p}" for p, v in manifest["parts"].items() if wanted is None or p in wanted]
        return self.spark.read.option("basePath", f"{self.root}/data").parquet(*paths).drop(PART, VERSION) if paths else None

    @staticmethod
    def _folder(value) -> str:
        return f"{PART}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"

    # ------------------------------------------------------------ writing

    def publish(self, rows: DataFrame, by: str | Column, replaced: Iterable, label: str, sort_within: tuple[str, ...] = (),
                gate: Callable[[DataFrame], None] | None = None) -> int:
        """A version in which ``rows`` stand for the partitions ``replaced`` (values of ``by``, which must cover
        those of ``rows``); all others stay as they are. Partition values are numbers or plain words. Returns its number.

        ``gate`` gets the rows as they were written, before anyone else can see them; if it raises, they are
        removed, nothing is published, and the error goes on."""
        before = self.head()
        number = before["number"] + 1 if before else 1
        version = f"{VERSION}={number:010d}-{uuid.uuid4().hex[:8]}"
        out = rows.withColumn(PART, F.col(by) if isinstance(by, str) else by).hint("rebalance", PART)
        if sort_within:
            out = out.sortWithinPartitions(PART, *sort_within)
        out.write.partitionBy(PART).parquet(f"{self.root}/data/{version}")
        if gate is not None:
            try:
                gate(self.spark.read.schema(rows.schema).parquet(f"{self.root}/data/{version}").select(rows.columns))
            except Exception:
                self._fs.delete(self._path(f"{self.root}/data/{version}"), True)
                raise
        gone = {self._folder(v) for v in replaced}
        parts = {p: v for p, v in (before["parts"] if before else {}).items() if p not in gone}
        parts.update({p: version for p in self._names(f"{self.root}/data/{version}") if p.startswith(f"{PART}=")})
        self._commit({"number": number, "label": label, "parts": parts})
        return number

    def compact(self, by: str | Column, small: int = 64 << 20, files: int = 8, label: str = "compaction") -> int:
        """Publish the partitions that have more than ``files`` files under ``small`` bytes again, in files of the
        advisory size; the rows stay the same. Returns how many partitions were rewritten."""
        parts = (self.head() or {"parts": {}})["parts"]
        crowded = []
        for part, version in parts.items():
            sizes = [s.getLen() for s in self._fs.listStatus(self._path(f"{self.root}/data/{version}/{part}")) if s.getPath().getName().startswith("part-")]
            if sum(n < small for n in sizes) > files:
                crowded.append(part)
        if crowded:
            rows = self.spark.read.option("basePath", f"{self.root}/data").parquet(
                *[f"{self.root}/data/{parts[p]}/{p}" for p in crowded]).drop(PART, VERSION)
            values = [None if p.endswith("=__HIVE_DEFAULT_PARTITION__") else p.split("=", 1)[1] for p in crowded]
            self.publish(rows, by, values, label)
        return len(crowded)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove the manifests before the last ``keep`` and the folders that none of those kept names; returns the folders."""
        numbers = self._numbers()
        used = {f"{v}/{p}" for n in numbers[-keep:] for p, v in self._manifest(n)["parts"].items()}
        newest = f"{VERSION}={numbers[-1]:010d}" if numbers else ""
        removed = []
        for version in self._names(f"{self.root}/data"):
            if version[:len(newest)] > newest:
                continue  # a writer is at work
            parts = [p for p in self._names(f"{self.root}/data/{version}") if p.startswith(f"{PART}=")]
            unused = [p for p in parts if f"{version}/{p}" not in used]
            whole = len(unused) == len(parts)
            for folder in [version] if whole else [f"{version}/{p}" for p in unused]:
                self._fs.delete(self._path(f"{self.root}/data/{folder}"), True)
                removed.append(folder)
        for n in numbers[:-keep]:
            self._fs.delete(self._path(f"{self.root}/manifest/{n:010d}.json"), False)
        return removed
