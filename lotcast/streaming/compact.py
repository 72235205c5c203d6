"""Compaction of a landed folder while its stream goes on.

A stream of short micro-batches lands thousands of small files a day. The
folder belongs to the file sink, whose log says which files count, so its files
can't be replaced in place. The compactor reads the committed files that no
generation covers yet, writes their rows as larger files into a generation
folder beside it, and publishes a document that names the generation folders
and the files they stand for. Readers take the newest document and the sink's
committed files, read the generations and whatever is not covered, and so meet
every row once before, during and after a compaction.

Files are rewritten partition by partition, each without its partition columns,
so rows stream from reader to writer: a write by partition values would sort
all rows of a task first.

Generations are merged when ``FAN_IN`` of one level have come together, so a row
is rewritten once a level: as often as the logarithm of the history.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lotcast.sinks.commits import Documents, delete, exists, names, read_text, size, write_new

TARGET_BYTES = 256 << 20
FAN_IN = 8


class CompactedFolder:
    """A landed folder (Parquet, partitioned by ``partition_by``) with its
    generations under ``root``."""

    def __init__(self, spark: SparkSession, landed: str, root: str, schema: StructType,
                 partition_by: Sequence[str] = ()) -> None:
        self.spark, self.landed, self.root = spark, landed.rstrip("/"), root.rstrip("/")
        self.schema, self.partition_by = schema, list(partition_by)
        self.documents = Documents(spark, f"{self.root}/generations")

    def committed(self) -> list[str]:
        """The files that the sink's log (or, without one, the folder) holds."""
        return sorted(self.spark.read.schema(self.schema).parquet(self.landed).inputFiles())

    def _state(self, number: int) -> dict:
        return self.documents.read(number) if number else {"folders": [], "covered": None}

    def _covered(self, state: dict) -> set[str]:
        return set(read_text(self.spark, f"{self.root}/covered/{state['covered']}").splitlines()) if state["covered"] else set()

    def _files(self, files: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).option("basePath", self.landed).parquet(*files)

    def _folder(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{name}")

    def read(self) -> DataFrame:
        """Every landed row once. The files are settled here: what is
        landed or compacted later doesn't change this DataFrame."""
        state = self._state(self.documents.latest())
        covered = self._covered(state)
        small = [f for f in self.committed() if f not in covered]
        parts = [self._folder(f["name"]) for f in state["folders"]] + ([self._files(small)] if small else [])
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.schema)

    def _write(self, files: Sequence[str], target_bytes: int, level: int) -> dict:
        name = uuid.uuid4().hex
        folders: dict[str, list[str]] = {}
        for file in files:
            parts = file.split("/")
            folders.setdefault(unquote("/".join(parts[len(parts) - 1 - len(self.partition_by): -1])), []).append(file)
        inside = StructType([f for f in self.schema if f.name not in self.partition_by])
        for folder, own in sorted(folders.items()):
            tasks = max(1, math.ceil(sum(size(self.spark, f) for f in own) / target_bytes))
            few = self.spark.read.schema(inside).parquet(*own).coalesce(tasks)  # no shuffle
            few.write.parquet(f"{self.root}/data/{name}/{folder}".rstrip("/"))
        return {"name": name, "level": level, "bytes": size(self.spark, f"{self.root}/data/{name}")}

    def compact(self, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN, least_files: int = 2) -> int | None:
        """Cover what has landed since the last generation. Returns the
        document's number, or None if there is nothing to do or another
        compactor was faster (its generation stands; this one's files go)."""
        number = self.documents.latest()
        state = self._state(number)
        covered, committed = self._covered(state), self.committed()
        small = [f for f in committed if f not in covered]
        if len(small) < least_files:
            return None
        folders = list(state["folders"])
        new = [self._write(small, target_bytes, 0)]
        folders += new
        level = 0
        while len(same := [f for f in folders if f["level"] == level]) >= fan_in:
            merged = self._write([x for f in same for x in self._folder(f["name"]).inputFiles()], target_bytes, level + 1)
            new.append(merged)
            folders = [f for f in folders if f["level"] != level] + [merged]
            level += 1
        list_name = uuid.uuid4().hex
        # Files that the sink's log has forgotten need no mention.
        write_new(self.spark, f"{self.root}/covered/{list_name}", "\n".join(sorted(covered.intersection(committed).union(small))))
        published = self.documents.publish({"folders": folders, "covered": list_name}, after=number)
        if published is None:
            for folder in new:
                delete(self.spark, f"{self.root}/data/{folder['name']}")
            delete(self.spark, f"{self.root}/covered/{list_name}")
        return published

    def vacuum(self, keep: int = 2) -> int:
        """Delete what the newest ``keep`` documents don't need: landed files
        covered by all of them, and generations that none names. Readers that
        began with an older document fail, and so does a stream that still has
        a deleted file to read: run it when those are through. Returns how
        many landed files went."""
        folders = names(self.spark, f"{self.root}/data")
        kept = sorted(self.documents.numbers())[-max(1, keep):]
        if not kept:
            return 0
        states = [self._state(n) for n in kept]
        covered = reduce(set.intersection, [self._covered(s) for s in states])
        used = {f["name"] for s in states for f in s["folders"]}
        lists = {s["covered"] for s in states}
        self.documents.drop_below(kept[0])
        for name in folders:
            if name not in used:
                delete(self.spark, f"{self.root}/data/{name}")
        for name in names(self.spark, f"{self.root}/covered"):
            if name not in lists:
                delete(self.spark, f"{self.root}/covered/{name}")
        gone = [f for f in covered if exists(self.spark, f)]
        for file in gone:
            delete(self.spark, file)
        return len(gone)
