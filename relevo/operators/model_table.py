"""Trained models as tables, and texts scored by a join with them.

``models`` holds a row for each collection: the hash size, the classes'
intercepts and what an index without a row of its own weighs; ``weights`` holds
a row for each (collection, hash index): the inverse document frequency and
the weight of every class.  A text's hashed terms are joined with the weights
of its collection and summed by text, and the sums go through the link
function.  The plan is the same for one collection and for a million; texts
are read once, whatever the number of models.
"""

from __future__ import annotations

import math
import threading
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo.operators.features import entries, hash_tokens, idf_of, term_frequencies
from relevo.operators.joins import attach_small
from relevo.session import materialize, work_folder

MODELS = "collection_id string, kind string, num_features int, n_classes int, intercepts array<double>, defaults array<double>, label double"
WEIGHTS = "collection_id string, idx int, idf double, weights array<double>"
#: Rows of weights that are written at a time.
_BATCH = 1_000_000


@dataclass
class ModelTable:
    """``sizes``: the hash sizes in use; ``width``: the most weights a term
    has.  ``label`` (with no hash size) is the answer for every text of a
    collection whose training rows held one class.  A model of one weight a
    term is a binary one, of several it has a weight for each class."""

    models: DataFrame
    weights: DataFrame
    sizes: tuple[int, ...]
    width: int

    def save(self, path: str) -> None:
        self.models.write.mode("overwrite").parquet(f"{path}/models")
        self.weights.write.mode("overwrite").parquet(f"{path}/weights")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ModelTable:
        models = spark.read.schema(MODELS).parquet(f"{path}/models")
        shapes = models.filter("num_features IS NOT NULL").select("num_features", "n_classes").distinct().collect()
        return cls(models, spark.read.schema(WEIGHTS).parquet(f"{path}/weights"), tuple(sorted({r[0] for r in shapes})), max((r[1] for r in shapes), default=0))


class WeightSink:
    """Weights of fitted models on their way to a table of the shared folder,
    a batch of rows at a time (fits may come from several threads)."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema
        self.held, self.count, self.lock = [], 0, threading.Lock()

    def add(self, keys: dict, idf: np.ndarray, classes: np.ndarray) -> None:
        """The indices that any class weighs; ``keys`` hold for all of them."""
        import pyarrow as pa

        idx = np.flatnonzero((classes != 0).any(axis=0))
        offsets = np.arange(len(idx) + 1, dtype=np.int32) * classes.shape[0]
        columns = {k: pa.array([v] * len(idx), pa.string() if isinstance(v, str) else pa.int32()) for k, v in keys.items()}
        columns |= {"idx": pa.array(idx, pa.int32()), "idf": pa.array(idf[idx]), "weights": pa.ListArray.from_arrays(pa.array(offsets), pa.array(classes[:, idx].T.ravel()))}
        with self.lock:
            self.held.append(columns)
            self.count += len(idx)
            if self.count >= _BATCH:
                self._flush()

    def _flush(self) -> None:
        import pyarrow as pa

        table = pa.table({n: pa.concat_arrays([h[n] for h in self.held]) for n in self.held[0]}) if self.held else []
        self.spark.createDataFrame(table, self.schema).write.mode("append").parquet(self.path)
        self.held, self.count = [], 0

    def table(self) -> DataFrame:
        with self.lock:
            self._flush()
        return self.spark.read.schema(self.schema).parquet(self.path)


def coefficients(kind: str, classifier) -> tuple[np.ndarray, np.ndarray]:
    """(intercepts, class by index) of a fitted classifier."""
    if kind == "naive_bayes":
        return classifier.pi.toArray(), classifier.theta.toArray()
    if kind == "multinomial":
        return classifier.interceptVector.toArray(), classifier.coefficientMatrix.toArray()
    return np.array([classifier.intercept]), classifier.coefficients.toArray()[None, :]


def model_table(spark: SparkSession, models: dict) -> ModelTable:
    """The table of a run's fitted models (``CollectionModel`` by collection),
    written to the shared folder.  A model's weights pass through the driver
    one model after the other, as its fit left them there."""
    path = f"{work_folder(spark)}/models-{uuid.uuid4().hex}"
    heads, sizes, width = [], set(), 0
    sink = WeightSink(spark, f"{path}/weights", WEIGHTS)
    for cid, m in sorted(models.items()):
        if m.model is None:
            heads.append((cid, m.kind, None, None, None, None, None if m.label is None else float(m.label)))
            continue
        intercepts, classes = coefficients(m.kind, m.model.stages[2])
        heads.append((cid, m.kind, classes.shape[1], classes.shape[0], intercepts.tolist(), [0.0] * classes.shape[0], None))
        sizes.add(classes.shape[1])
        width = max(width, classes.shape[0])
        sink.add({"collection_id": cid}, m.model.stages[1].idf.toArray(), classes)
    spark.createDataFrame(heads, MODELS).write.parquet(f"{path}/models")
    return ModelTable(spark.read.schema(MODELS).parquet(f"{path}/models"), sink.table(), tuple(sorted(sizes)), width)


def naive_bayes_table(training: DataFrame, num_features: int, smoothing: float = 1.0, tokens_col: str = "filtered", by: str = "collection_id") -> ModelTable:
    """Multinomial naive Bayes on hashed TF-IDF for all collections at once,
    from one aggregate over the training rows: equal to the library's
    classifier fitted collection by collection.  Labels are 0.0 and 1.0; a
    collection of one class gets that class."""
    rows = training.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1.0).alias("n1"), F.max("label").alias("top"))
    positive = F.col("label") == 1.0
    terms = term_frequencies(training, num_features, tokens_col, keep=(by, "label"))
    sums = terms.groupBy(by, "idx").agg(F.count(F.lit(1)).alias("df"), F.sum(F.when(positive, 0.0).otherwise(F.col("tf"))).alias("s0"), F.sum(F.when(positive, F.col("tf")).otherwise(0.0)).alias("s1"))
    sums = attach_small(sums, rows.select(by, "n"), by).withColumn("idf", idf_of("n", "df"))
    sums = materialize(sums.select(by, "idx", "idf", *[(F.col("idf") * F.col(s)).alias(s) for s in ("s0", "s1")]), "class-sums")
    totals = sums.groupBy(by).agg(F.sum("s0").alias("t0"), F.sum("s1").alias("t1"))
    heads = rows.join(totals, by, "left")
    log_all = [F.ln(F.coalesce(f"t{c}", F.lit(0.0)) + F.lit(num_features * smoothing)) for c in (0, 1)]
    prior = [F.ln(n + F.lit(smoothing)) - F.ln(F.col("n") + F.lit(2.0 * smoothing)) for n in (F.col("n") - F.col("n1"), F.col("n1"))]
    both = (F.col("n1") > 0) & (F.col("n1") < F.col("n"))
    rare = idf_of("n", F.lit(0))  # of a term that no training row has
    models = heads.select(
        F.col(by).alias("collection_id"),
        F.when(both, "naive_bayes").otherwise("constant").alias("kind"),
        F.when(both, num_features).alias("num_features"),
        F.when(both, 2).alias("n_classes"),
        F.when(both, F.array(*prior)).alias("intercepts"),
        F.when(both, F.array(*[rare * (F.lit(math.log(smoothing)) - x) for x in log_all])).alias("defaults"),
        F.when(~both, F.col("top")).alias("label"),
        *[x.alias(f"_l{c}") for c, x in enumerate(log_all)],
    )
    models = materialize(models, "bayes-models")
    weights = attach_small(sums.withColumnRenamed(by, "collection_id"), models.filter("n_classes = 2").select("collection_id", "_l0", "_l1"), "collection_id")
    weights = weights.select("collection_id", "idx", "idf", F.array(*[F.ln(F.col(f"s{c}") + F.lit(smoothing)) - F.col(f"_l{c}") for c in (0, 1)]).alias("weights"))
    return ModelTable(models.drop("_l0", "_l1"), materialize(weights, "bayes-weights"), (num_features,), 2)


def _probabilities(raws: Column) -> Column:
    """Class probabilities of raw scores; one raw score is a binary margin."""
    top = F.array_max(raws)
    powers = F.transform(raws, lambda x: F.exp(x - top))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.get(raws, F.lit(0))))
    return F.when(F.size(raws) == 1, F.array(F.lit(1.0) - p1, p1)).otherwise(F.transform(powers, lambda x: x / total))


def _head(k: int) -> Column:
    return F.struct("num_features", "n_classes", "intercepts", "defaults", "label").alias(f"_m{k}")


def raw_scores(tables: Sequence[ModelTable], rows: DataFrame, keep: Sequence[str] = (), tokens_col: str = "filtered") -> DataFrame:
    """``id, collection_id, *keep`` and, for the k-th table, ``label_k`` and
    ``raw_k`` (the classes' raw scores; null without a model): a row for every
    row.

    Terms are exploded and joined with the weights on (table, collection,
    index); a text's sums are formed where its terms are, so one row a text
    is shuffled.  The tables of models and weights are broadcast as long as
    the planner finds their files small enough, else the joins shuffle and a
    hot collection's or term's partition is split."""
    common = ["id", "collection_id", *keep]
    base = rows.select(*common, F.col(tokens_col).alias("_terms"), F.monotonically_increasing_id().alias("_row"))
    sets, weights = [], None
    for k, t in enumerate(tables):
        base = base.join(t.models.select("collection_id", _head(k)), "collection_id", "left")
        own = t.weights.select(F.lit(k).alias("_set"), "collection_id", F.col("idx").alias("_idx"), *[(F.col("idf") * F.get("weights", F.lit(c))).alias(f"_w{c}") for c in range(max(t.width for t in tables))])
        weights = own if weights is None else weights.unionByName(own)
    hashed = base
    for n in sorted({n for t in tables for n in t.sizes}):
        # a text is hashed to the sizes of its own models
        wanted = reduce(or_, [F.coalesce(F.col(f"_m{k}.num_features") == n, F.lit(False)) for k, t in enumerate(tables) if n in t.sizes])
        hashed = hash_tokens(hashed.withColumn("_own", F.when(wanted, F.col("_terms"))), [n], "_own").drop("_own")
    none = F.array().cast("array<struct<table:int,idx:int,tf:double>>")
    for k, t in enumerate(tables):
        size = F.col(f"_m{k}.num_features")
        terms = none
        for n in t.sizes:
            terms = F.when(size == n, entries(f"tf_{n}", table=k)).otherwise(terms)
        sets.append(F.coalesce(terms, none))
    # of the models' heads an entry only needs what an index without weights weighs
    rare = [F.get(f"_m{k}.defaults", F.lit(c)).alias(f"_d{k}_{c}") for k, t in enumerate(tables) for c in range(t.width)]
    exploded = hashed.select("_row", *common, *rare, F.concat(*sets).alias("_es"))
    rare = exploded.columns[1 + len(common) : -1]
    exploded = exploded.select("_row", *common, *rare, F.explode_outer("_es").alias("_e"))
    exploded = exploded.select("_row", *common, *rare, F.col("_e.table").alias("_set"), F.col("_e.idx").alias("_idx"), F.col("_e.tf").alias("_tf"))
    joined = exploded.join(weights, ["_set", "collection_id", "_idx"], "left")
    sums = []
    for k, t in enumerate(tables):
        for c in range(t.width):
            part = F.col("_tf") * F.coalesce(f"_w{c}", f"_d{k}_{c}")
            sums.append(F.sum(F.when(F.col("_set") == k, part)).alias(f"_s{k}_{c}"))
    # only sums, which a hash aggregate holds; the models' heads are joined again
    whole = joined.groupBy("_row", *common).agg(F.count(F.lit(1)).alias("_n"), *sums)
    for k, t in enumerate(tables):
        whole = whole.join(t.models.select("collection_id", _head(k)), "collection_id", "left")
    out = [F.col(c) for c in common]
    for k, t in enumerate(tables):
        m = F.col(f"_m{k}")
        raws = [F.get(m["intercepts"], F.lit(c)) + F.coalesce(f"_s{k}_{c}", F.lit(0.0)) for c in range(t.width)]
        raw = F.slice(F.array(*raws), F.lit(1), F.coalesce(m["n_classes"], F.lit(0))) if raws else F.array().cast("array<double>")
        out += [m["label"].alias(f"label_{k}"), F.when(m["n_classes"].isNotNull(), raw).alias(f"raw_{k}")]
    return whole.select(*out)


def class_scores(raw: Column, label: Column) -> dict[str, Column]:
    """``prediction`` (the first most probable class), ``probability`` (an
    array) and ``status`` of raw scores, or of the one class."""
    p = _probabilities(raw)
    trained, single = raw.isNotNull(), label.isNotNull()
    return {
        "prediction": F.when(trained, F.array_position(p, F.array_max(p)).cast("double") - 1.0).otherwise(label),
        "probability": F.when(trained, p),
        "status": F.when(trained, "trained").when(single, "one_class").otherwise("untrained"),
    }

