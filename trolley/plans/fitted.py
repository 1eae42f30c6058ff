"""Fitted models that are stored and opened again, instead of being fit by each query.

A model is written to a folder of its own and renamed to its place when it is whole, so that a half-written one is never
opened. The place is named by what the model depends on: the state of the source files, its kind and parameters.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from trolley.session import ensure_checkpoint_dir


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def model_path(spark: SparkSession, name: str, *parts: Any) -> str:
    """Where the model of this name is stored, for these sources and parameters."""
    digest = hashlib.sha1("|".join(map(repr, parts)).encode()).hexdigest()[:16]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/trolley-models/{name}-{digest}"


def save_whole(spark: SparkSession, model, path: str) -> None:
    """Write beside the place, then rename; a model that is already there stays."""
    fs, Path = _filesystem(spark, path)
    part = f"{path}.part-{uuid.uuid4().hex}"
    PipelineModel(stages=[model]).save(part)
    if not fs.rename(Path(part), Path(path)) and not fs.exists(Path(path)):
        raise OSError(f"can't move the stored model to {path}")
    # Where another application stored it first, some file systems move the folder into the one that is there.
    inner = Path(f"{path}/{part.rsplit('/', 1)[-1]}")
    if fs.exists(inner):
        fs.delete(inner, True)


def stored_model(spark: SparkSession, path: str, fit: Callable[[], Any]):
    """The model stored at ``path``; fit and stored there if there is none. What is returned was read from the files."""
    fs, Path = _filesystem(spark, path)
    if not fs.exists(Path(path)):
        save_whole(spark, fit(), path)
    return PipelineModel.load(path).stages[0]
