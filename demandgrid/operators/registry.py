"""Model versions, their metrics and inputs, and the run log, as plain tables."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.schemas import REGISTRY, RUNS
from demandgrid.session import claim

#: What a frame to be scored need not have.
NOT_SCORED = ("target",)
LENGTH = "length"


class Difference(NamedTuple):
    """``kind``: missing, type or length."""

    column: str
    kind: str
    expected: str
    found: str | None


class InputMismatch(ValueError):
    """A frame is not of the kind that a model was trained on."""

    def __init__(self, model: str, differences: list[Difference]):
        self.differences = differences
        told = "; ".join(f"{d.column}: {d.kind}, expected {d.expected}, found {d.found}" for d in differences)
        super().__init__(f"inputs of model {model!r} differ: {told}")


def input_schema(inputs: DataFrame) -> T.StructType:
    """The schema, with the length of arrays in the first row: windows of one frame are equally long."""
    arrays = [f.name for f in inputs.schema if isinstance(f.dataType, T.ArrayType)]
    row = inputs.select(*[F.size(f"`{a}`").alias(a) for a in arrays]).first() if arrays else None
    lengths = row.asDict() if row else {}
    return T.StructType(
        [T.StructField(f.name, f.dataType, f.nullable, {LENGTH: lengths[f.name]} if lengths.get(f.name) is not None else {}) for f in inputs.schema]
    )


def input_differences(trained: T.StructType, given: T.StructType, optional: Iterable[str] = NOT_SCORED) -> list[Difference]:
    """What of the ``trained`` columns ``given`` lacks or has of another type or length; other columns don't matter."""
    there, out = {f.name: f for f in given}, []
    for f in trained:
        found, kind = there.get(f.name), f.dataType.simpleString()
        if found is None:
            if f.name not in optional:
                out.append(Difference(f.name, "missing", kind, None))
        elif found.dataType.simpleString() != kind:
            out.append(Difference(f.name, "type", kind, found.dataType.simpleString()))
        elif {LENGTH} <= f.metadata.keys() & found.metadata.keys() and f.metadata[LENGTH] != found.metadata[LENGTH]:
            out.append(Difference(f.name, "length", str(f.metadata[LENGTH]), str(found.metadata[LENGTH])))
    return out


def describe_inputs(schema: T.StructType) -> str:
    """``lags array<bigint>[672], …``"""
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" + (f"[{f.metadata[LENGTH]}]" if LENGTH in f.metadata else "") for f in schema)


def latest_versions(registry: DataFrame) -> DataFrame:
    """The row with the greatest version of each name."""
    newest = F.max_by(F.struct(*[c for c in registry.columns if c != "name"]), "version")
    return registry.groupBy("name").agg(newest.alias("r")).select("name", "r.*")


def promotions(candidates: DataFrame, metric: str = "mae", order: str = "run") -> DataFrame:
    """Which candidates, taken in ``order`` per name, beat the version registered before them.

    Only better ones are ever registered, so the registered metric is the least seen so far. The first of a name is
    always registered. Adds ``previous`` and ``promoted``.
    """
    before = Window.partitionBy("name").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    previous = F.min(metric).over(before)
    return candidates.withColumn("previous", previous).withColumn(
        "promoted", F.coalesce(F.col(metric) < F.col("previous"), F.col("previous").isNull())
    )


def _append(rows: DataFrame, path: str) -> None:
    """Add rows in a folder of their own: jobs that append to one folder at the same time undo each other's files."""
    rows.write.parquet(os.path.join(path, f"rows={uuid.uuid4().hex}"))


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


class ModelRegistry:
    """Saved pipelines under ``root/models`` and one table row per version under ``root/registry``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.table_path = os.path.join(root, "registry")
        spark.createDataFrame([], REGISTRY).write.mode("ignore").parquet(self.table_path)

    def table(self) -> DataFrame:
        return _read(self.spark, self.table_path, REGISTRY)

    def entry(self, name: str, version: int | None = None) -> dict | None:
        """Newest version, or the one asked for; None when there is none."""
        rows = self.table().where(F.col("name") == name)
        rows = latest_versions(rows) if version is None else rows.where(F.col("version") == version)
        found = rows.take(1)
        return found[0].asDict() if found else None

    def metrics(self, name: str, version: int | None = None) -> dict[str, float] | None:
        entry = self.entry(name, version)
        return entry and entry["metrics"]

    def inputs(self, name: str, version: int | None = None) -> T.StructType:
        """What the model was trained on."""
        entry = self.entry(name, version)
        if entry is None:
            raise LookupError(f"no model {name!r} version {version or 'any'}")
        return T.StructType.fromJson(json.loads(entry["input_schema"]))

    def load(self, name: str, version: int | None = None, inputs: DataFrame | None = None) -> PipelineModel:
        """The model; raises ``InputMismatch`` if ``inputs``, the frame to be scored, is not of the kind it was trained on."""
        entry = self.entry(name, version)
        if entry is None:
            raise LookupError(f"no model {name!r} version {version or 'any'}")
        if inputs is not None:
            trained = T.StructType.fromJson(json.loads(entry["input_schema"]))
            differences = input_differences(trained, input_schema(inputs))
            if differences:
                raise InputMismatch(name, differences)
        return PipelineModel.load(entry["path"])

    def register(self, name: str, model: PipelineModel, metrics: Mapping[str, float], inputs: DataFrame) -> int:
        """Save under the next version that no one else has claimed. The table row is appended after the model is complete; the
        version of a job that died before is left out."""
        newest = self.entry(name)
        version = 1 if newest is None else newest["version"] + 1
        folder = os.path.join(self.root, "models", name)
        while not claim(self.spark, os.path.join(folder, "_claims", f"v{version}")):
            version += 1
        path = os.path.join(folder, f"v{version}")
        model.write().overwrite().save(path)
        row = (name, version, path, {k: float(v) for k, v in metrics.items()}, input_schema(inputs).json())
        _append(self.spark.createDataFrame([row], REGISTRY).coalesce(1), self.table_path)
        return version

    def register_if_better(
        self, name: str, model: PipelineModel, metrics: Mapping[str, float], inputs: DataFrame, gate: str = "test_mae"
    ) -> int | None:
        """New version if ``gate`` is lower than the registered one or nothing is registered; else None."""
        current = self.metrics(name)
        if current is not None and gate in current and not metrics[gate] < current[gate]:
            return None
        return self.register(name, model, metrics, inputs)


def log_run(
    spark: SparkSession,
    path: str,
    experiment: str,
    model: str,
    metric: str = "metric",
    score: float | None = None,
    params: Mapping[str, object] | None = None,
) -> None:
    """Append one row to the run log."""
    row = (experiment, model, {k: str(v) for k, v in (params or {}).items()}, metric, score)
    _append(spark.createDataFrame([row], RUNS).coalesce(1), path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, RUNS)


def append_runs(runs: DataFrame, path: str) -> None:
    """Append many runs at once."""
    _append(runs.select(*RUNS.names), path)
