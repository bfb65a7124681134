"""Fitted models of a run: saved by the classification job, loaded by the
stream."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from relevo.operators.model import CollectionModel
from relevo.operators.model_table import ModelTable, model_table
from relevo.session import publish
from relevo.sources.sinks import load_model, save_model

_TABLE = "id string, kind string, metric double, metrics string, label double, folds int, saved boolean"


def save_models(models: dict[str, CollectionModel], path: str, table: ModelTable | None = None) -> None:
    """A small table of the collections, one folder for each fitted model, and
    the models' table for scoring; published as a whole by one rename."""
    if not models:
        return
    spark = SparkSession.getActiveSession()
    target, path = path, f"{path.rstrip('/')}.part-{uuid.uuid4().hex}"
    rows = [(cid, m.kind, m.cv_auc, json.dumps(m.all_auc), m.label, m.folds, m.model is not None) for cid, m in sorted(models.items())]
    for n, (_, m) in enumerate(sorted(models.items())):
        if m.model is not None:
            save_model(m.model, f"{path}/model-{n:06d}")
    numbered = [(n, *r) for n, r in enumerate(rows)]
    spark.createDataFrame(numbered, f"n int, {_TABLE}").coalesce(1).write.mode("overwrite").parquet(f"{path}/collections")
    (table or model_table(spark, models)).save(f"{path}/table")
    publish(spark, path, target)


def load_table(spark: SparkSession, path: str) -> ModelTable:
    """The saved models as a table, without loading them."""
    return ModelTable.load(spark, f"{path}/table")


def load_models(spark: SparkSession, path: str) -> dict[str, CollectionModel]:
    out = {}
    for r in spark.read.parquet(f"{path}/collections").collect():
        model = load_model(f"{path}/model-{r['n']:06d}") if r["saved"] else None
        out[r["id"]] = CollectionModel(r["id"], r["kind"], model, r["metric"], json.loads(r["metrics"]), r["label"], r["folds"])
    return out
