"""Least squares that grows with its arrivals.

A linear fit needs the rows only through their sufficient statistics: how many
there are, and the sums of the features, the label and their products. One
aggregation gives them for an arrival, they are stored under the arrival's name,
and a fit adds up what is stored; no earlier row is read again.

Sums are taken of deviations from a fixed point (the means of the first
arrival, kept with the store), so that large values don't cancel. The fit
itself is ``spark.ml``'s: the sums are turned into a few weighted points with
the same means and the same products, and ``LinearRegression`` on those gives
the coefficients it would give on all rows, in an ordinary ``PipelineModel``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lotcast.ml.models import assembler, prediction_col, usable
from lotcast.sinks.commits import checkpoint_stream_id, names, read_text, write_new
from lotcast.streaming.ingest import _trigger


@dataclass(frozen=True)
class Moments:
    """Rows seen, rows used, and of the used ones the sums and the sums of
    products of (features, label), as deviations from a fixed point."""

    seen: int
    used: int
    sums: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.seen + other.seen, self.used + other.used, self.sums + other.sums, self.products + other.products)


def _pairs(width: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(width) for j in range(i, width)]


def moments(df: DataFrame, features: Sequence[str], label: str, origin: Sequence[float]) -> Moments:
    """One scan and one aggregation, with a partial sum in every task. Rows
    that are not :func:`usable` are counted and left out."""
    good = usable(df, features, label)
    deviations = [F.col(c).cast("double") - F.lit(float(o)) for c, o in zip([*features, label], origin)]
    held = df.select(good.alias("good"), *[F.when(good, x).alias(f"x{i}") for i, x in enumerate(deviations)])
    width = len(deviations)
    total = [F.sum(f"x{i}") for i in range(width)]
    total += [F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i, j in _pairs(width)]
    row = held.agg(F.count(F.lit(1)), F.count_if("good"), *total).first()
    values = np.array([v or 0.0 for v in row[2:]])
    products = np.zeros((width, width))
    for (i, j), v in zip(_pairs(width), values[width:]):
        products[i, j] = products[j, i] = v
    return Moments(row[0], row[1], values[:width], products)


def points(found: Moments, origin: Sequence[float]) -> list[tuple[float, list[float]]]:
    """Weighted points (weight, features and label) with these moments: one
    pair on each principal axis, both sides of the mean."""
    width = len(found.sums)
    mean = found.sums / found.used
    spread = found.products / found.used - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(spread), 0.0))
    scale[scale == 0] = 1.0
    values, axes = np.linalg.eigh(spread / np.outer(scale, scale))
    steps = axes * np.sqrt(np.maximum(values, 0.0) * width) * scale[:, None]
    center = mean + np.asarray(origin, float)
    return [(found.used / (2 * width), (center + sign * steps[:, k]).tolist()) for k in range(width) for sign in (1, -1)]


class GrowingFit:
    """A store of moments under ``root``, for one list of features and a label.

    ``add`` takes an arrival once: a name that is there already is left alone,
    so a job or a micro-batch that runs again adds nothing twice.
    """

    def __init__(self, spark: SparkSession, root: str, features: Sequence[str], label: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.features, self.label = list(features), label

    def _origin(self, df: DataFrame) -> list[float] | None:
        """The fixed point: the first arrival's means. Of two first arrivals
        at once, one writes it and both read it."""
        at = f"{self.root}/origin.json"
        if "origin.json" not in names(self.spark, self.root):
            columns = [*self.features, self.label]
            means = df.where(usable(df, self.features, self.label)).agg(*[F.avg(F.col(c).cast("double")) for c in columns]).first()
            if means[0] is None:  # nothing usable yet
                return None
            write_new(self.spark, at, json.dumps({"columns": columns, "origin": list(means)}))
        kept = json.loads(read_text(self.spark, at))
        if kept["columns"] != [*self.features, self.label]:
            raise ValueError(f"{self.root} holds moments of {kept['columns']}")
        return kept["origin"]

    def add(self, df: DataFrame, arrival: str) -> bool:
        """Add the rows of an arrival; False if it was there already."""
        name = f"{arrival}.json"
        if name in names(self.spark, f"{self.root}/arrivals"):
            return False
        origin = self._origin(df)
        if origin is None:
            kept = {"seen": df.count(), "used": 0}
        else:
            found = moments(df, self.features, self.label, origin)
            kept = {"seen": found.seen, "used": found.used, "sums": found.sums.tolist(), "products": found.products.tolist()}
        return write_new(self.spark, f"{self.root}/arrivals/{name}", json.dumps(kept))

    def arrivals(self) -> list[str]:
        return [n[:-5] for n in names(self.spark, f"{self.root}/arrivals") if n.endswith(".json")]

    def total(self) -> Moments:
        """All arrivals added up (a few kilobytes each, whatever their rows)."""
        width = len(self.features) + 1
        total = Moments(0, 0, np.zeros(width), np.zeros((width, width)))
        for name in self.arrivals():
            kept = json.loads(read_text(self.spark, f"{self.root}/arrivals/{name}.json"))
            sums = np.array(kept.get("sums", np.zeros(width)))
            total += Moments(kept["seen"], kept["used"], sums, np.array(kept.get("products", np.zeros((width, width)))))
        return total

    def fit(self, name: str, features_col: str = "features") -> PipelineModel:
        """The least-squares model of all rows so far, as ``fit_all`` returns
        it under ``name``."""
        total = self.total()
        if total.used == 0:
            raise ValueError(f"no usable row has arrived in {self.root}")
        origin = json.loads(read_text(self.spark, f"{self.root}/origin.json"))["origin"]
        rows = [(w, Vectors.dense(z[:-1]), z[-1]) for w, z in points(total, origin)]
        training = self.spark.createDataFrame(rows, ["weight", features_col, self.label])
        model = LinearRegression(featuresCol=features_col, labelCol=self.label, predictionCol=prediction_col(name),
                                 weightCol="weight", solver="normal").fit(training)
        return PipelineModel(stages=[assembler(self.features, features_col), model])

    def add_stream(self, df: DataFrame, checkpoint: str, trigger: str | None = "availableNow") -> StreamingQuery:
        """Add every micro-batch of a stream as an arrival of its own."""
        stream_id = checkpoint_stream_id(self.spark, checkpoint)

        def run(batch: DataFrame, batch_id: int) -> None:
            self.add(batch, f"{stream_id}-{batch_id}")

        return _trigger(df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), trigger).start()
