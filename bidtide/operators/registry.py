"""Versioned model table: one folder per source, one committed attempt per version, one row per weight.

A version becomes visible when its marker is written, after its rows, and is never overwritten or removed: a reader that has
found it can go on reading while others publish. Writing a version again keeps what is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bidtide.functions.score import LinearModel
from bidtide.schemas import MODEL_WEIGHTS
from bidtide.sinks import commits

INTERCEPT = "(intercept)"


def model_rows(spark: SparkSession, model: LinearModel) -> DataFrame:
    names, values = [INTERCEPT, *model.features], [model.intercept, *model.weights]
    rows = [
        (model.version, model.source, i, name, float(value), len(model.features), model.examples)
        for i, (name, value) in enumerate(zip(names, values))
    ]
    return spark.createDataFrame(rows, MODEL_WEIGHTS).coalesce(1)


def save_model(spark: SparkSession, model: LinearModel, root: str) -> str:
    """Commit ``model`` under its own version, unless there is one; the folder that counts."""
    return commits.commit(model_rows(spark, model), f"{root}/{model.source}", f"{model.version:012d}")


def publish(spark: SparkSession, model: LinearModel, root: str, attempts: int = 20) -> LinearModel:
    """Save ``model`` as the next version of its source. If another publisher takes that number first, the one after it."""
    for _ in range(attempts):
        numbered = model.at_version(max(_versions(spark, root, model.source), default=-1) + 1)
        save_model(spark, numbered, root)
        # Another publisher's marker may have come first.
        if load_version(spark, root, model.source, numbered.version) == numbered:
            return numbered
    raise RuntimeError("other publishers took every version number tried")


def _versions(spark: SparkSession, root: str, source: str) -> dict[int, str]:
    """The committed versions of a source and their folders, newest first."""
    found = commits.committed(spark, f"{root}/{source}")
    return dict(sorted(((int(name), folder) for name, folder in found.items()), reverse=True))


def _read(spark: SparkSession, folder: str) -> LinearModel:
    rows = sorted(spark.read.schema(MODEL_WEIGHTS).parquet(folder).collect(), key=lambda r: r["position"])
    return LinearModel(
        [r["feature"] for r in rows[1:]], [r["weight"] for r in rows[1:]], rows[0]["weight"],
        source=rows[0]["source"], version=rows[0]["version"], examples=rows[0]["examples"],
    )


def load_version(spark: SparkSession, root: str, source: str, version: int) -> LinearModel | None:
    """One version, or None if it is not committed."""
    folder = _versions(spark, root, source).get(version)
    return _read(spark, folder) if folder else None


def load_latest(spark: SparkSession, root: str, source: str, below: int | None = None) -> LinearModel | None:
    """The newest version of ``source``, of those below a version if one is given. Markers are listed and one version is
    read, so the cost hardly grows with the history."""
    for version, folder in _versions(spark, root, source).items():
        if below is None or version < below:
            return _read(spark, folder)
    return None


def models(spark: SparkSession, root: str, source: str) -> DataFrame:
    """All weights of all versions of ``source``."""
    folders = list(_versions(spark, root, source).values())
    return spark.read.schema(MODEL_WEIGHTS).parquet(*folders) if folders else spark.createDataFrame([], MODEL_WEIGHTS)


def current_model(spark: SparkSession, root: str) -> LinearModel | None:
    """The online model once there is one, until then the batch model, and None without either."""
    return load_latest(spark, root, "online") or load_latest(spark, root, "batch")
