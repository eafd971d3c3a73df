"""Fit/transform stage protocol on top of ``pyspark.ml``.

Custom stages subclass ``pyspark.ml.Estimator`` / ``pyspark.ml.Model`` so they
chain inside a ``pyspark.ml.Pipeline`` next to built-in stages.  Fitted state
is either a few scalars per column (kept as plain attributes, bounded by the
number of columns) or a dimension table (a DataFrame written to the shared
checkpoint folder, so repeated transforms do not recompute the fit).

Persistence: ``save(path)`` writes ``state.json`` plus one parquet folder per
DataFrame attribute; ``load_stage(path)`` restores any stage.
"""

from __future__ import annotations

import importlib
import os

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, SparkSession

from ..session import cut_lineage, read_json, scratch_path, write_json


class Stage(Estimator):
    """Estimator base: subclasses implement ``_fit(df) -> FittedStage``."""

    def __init__(self):
        super().__init__()


class FittedStage(Model):
    """Model base with JSON + parquet persistence."""

    _frames: tuple = ()

    def __init__(self):
        super().__init__()

    # -- persistence -------------------------------------------------------
    def _state(self) -> dict:
        return {k: v for k, v in self.__dict__.items()
                if not k.startswith("_") and k not in self._frames and k != "uid"}

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        present = [n for n in self._frames if getattr(self, n) is not None]
        meta = {"class": f"{type(self).__module__}.{type(self).__qualname__}", "state": self._state(),
                "frames": list(self._frames), "present": present}
        write_json(spark, os.path.join(path, "state.json"), meta, default=_jsonable)
        for name in present:
            getattr(self, name).write.mode("overwrite").parquet(os.path.join(path, name))

    @classmethod
    def _restore(cls, spark: SparkSession, path: str, meta: dict):
        obj = cls.__new__(cls)
        FittedStage.__init__(obj)
        obj.__dict__.update(meta["state"])
        present = set(meta.get("present", ()))
        for name in meta["frames"]:
            p = os.path.join(path, name)
            setattr(obj, name, spark.read.parquet(p) if name in present else None)
        return obj


def _jsonable(o):
    if hasattr(o, "tolist"):
        return o.tolist()
    if isinstance(o, (set, tuple)):
        return list(o)
    raise TypeError(f"cannot serialise {type(o)}")


def load_stage(spark: SparkSession, path: str) -> FittedStage:
    meta = read_json(spark, os.path.join(path, "state.json"))
    mod, _, name = meta["class"].rpartition(".")
    cls = getattr(importlib.import_module(mod), name)
    return cls._restore(spark, path, meta)


def materialise(df: DataFrame) -> DataFrame:
    """Write fitted state to the shared checkpoint folder (cuts lineage)."""
    return cut_lineage(df)


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write a fitted table to the shared checkpoint folder as Parquet and read it back:
    Spark then knows its size in bytes, and joins to it accordingly."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_dimension(df: DataFrame, dim: DataFrame, keys, how: str = "left") -> DataFrame:
    """Join of the fact rows to a fitted dimension table.  No hint: Spark broadcasts a
    table below its own limit in bytes and else shuffles, and splits hot keys at runtime."""
    return df.join(dim, list(keys), how)
