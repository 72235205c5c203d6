"""Releases of saved models: published whole, picked up while streams run.

``root/models/<folder>`` holds the pipelines of one release and never changes;
``root/releases/<number>.json`` names them. A release is there when its
document is, so a scorer that loads models while a new release is being written
gets the old one whole, and never a mix.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from lotcast.ml.models import load_all, save_all
from lotcast.sinks.commits import Documents, delete, names


@dataclass(frozen=True)
class Release:
    version: int
    paths: dict[str, str]

    def load(self) -> dict[str, PipelineModel]:
        return load_all(self.paths)


class Registry:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.releases = Documents(spark, f"{self.root}/releases")
        self._held: tuple[int, dict[str, PipelineModel]] | None = None

    def publish(self, models: Mapping[str, PipelineModel]) -> Release:
        """Save the models in a folder of their own, then name them."""
        folder = uuid.uuid4().hex
        save_all(dict(models), f"{self.root}/models/{folder}")
        version = self.releases.publish({"folder": folder, "models": list(models)})
        return self.release(version)

    def release(self, version: int) -> Release:
        named = self.releases.read(version)
        return Release(version, {m: f"{self.root}/models/{named['folder']}/{m}" for m in named["models"]})

    def current(self) -> Release | None:
        """The newest release (None before the first)."""
        version = self.releases.latest()
        return self.release(version) if version else None

    def models(self, version: int | None = None) -> tuple[int, dict[str, PipelineModel]]:
        """Version and models of a release, the newest by default. The last
        one asked for stays loaded, so asking for every micro-batch costs one
        listing of a folder unless there is a new release."""
        version = self.releases.latest() if version is None else version
        if not version:
            raise LookupError(f"no release of models under {self.root}")
        if self._held is None or self._held[0] != version:
            self._held = version, self.release(version).load()
        return self._held

    def prune(self, keep: int = 3) -> None:
        """Forget all but the newest ``keep`` releases, and delete the
        folders that none of them names. Folders are listed before the
        documents are read, so a release published meanwhile keeps its own;
        a folder that is still being written has no document yet, so leave
        pruning to the process that publishes."""
        folders = names(self.spark, f"{self.root}/models")
        kept = sorted(self.releases.numbers())[-max(1, keep):]
        used = {self.releases.read(v)["folder"] for v in kept}
        if kept:
            self.releases.drop_below(kept[0])
        for folder in folders:
            if folder not in used:
                delete(self.spark, f"{self.root}/models/{folder}")
