"""Relevance classifiers: TF-IDF features and logistic regression, tuned by
cross-validation, one model per collection.

The tuned cells are (hash size, regularisation).  A fold is a hash of seed and
id, so it depends neither on the file layout nor on the number of rows.  Texts
are hashed once for all folds and cells; one aggregate of the hashed terms by
fold gives the IDF of every training part as total less fold.  The binary
and multinomial regressions of the grid are fitted together, in rounds that all
cells share (``grid_fits``); each chosen cell is one of Spark's distributed
fits, several at a time.  Naive Bayes needs no fits to be tuned, its class sums
are differences of the same aggregate.  All cells of all
collections are then judged by one join of the held-out terms with the cells'
weights and one exact ranking.

Every text gets a score row.  A collection whose training rows hold one class
gets that class (``status`` ``one_class``); a collection without training rows
gets nulls (``untrained``).  Scores come from the models' table
(``relevo.operators.model_table``), whose plan doesn't grow with collections.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import ElementwiseProduct, HashingTF, IDF
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.operators import grid_fits
from relevo.operators.features import exploded_entries, fold_frequencies, hashed_vectors, idf_of
from relevo.operators.joins import attach_small
from relevo.operators.labeling import hash_unit
from relevo.operators.model_table import ModelTable, WeightSink, class_scores, coefficients, model_table, raw_scores
from relevo.operators.ranking import area_under_roc, weighted_f1
from relevo.session import materialize, work_folder

# Model and tuning settings of the classification phase.
MAX_ITER = 10
REG_PARAM = 0.3
ELASTIC_NET_PARAM = 0.8
GRID_NUM_FEATURES = (10, 100, 1000, 10000)
GRID_REG_PARAM = (0.1, 0.01)
NUM_FOLDS = 5
CV_SEED = 12345


@dataclass
class TuningSpec:
    num_features: Sequence[int] = GRID_NUM_FEATURES
    reg_params: Sequence[float] = GRID_REG_PARAM
    num_folds: int = NUM_FOLDS
    seed: int = CV_SEED
    parallelism: int = 8
    feature_col: str = "filtered"
    classifiers: Sequence[str] = field(default_factory=lambda: ("logistic",))


def _classifier(kind: str, prefix: str = ""):
    cols = dict(
        featuresCol=f"{prefix}features",
        predictionCol=f"{prefix}prediction",
        probabilityCol=f"{prefix}probability",
        rawPredictionCol=f"{prefix}rawPrediction",
    )
    if kind == "logistic":
        return LogisticRegression(maxIter=MAX_ITER, regParam=REG_PARAM, elasticNetParam=ELASTIC_NET_PARAM, **cols)
    if kind == "naive_bayes":
        return NaiveBayes(modelType="multinomial", **cols)
    if kind == "multinomial":
        return LogisticRegression(
            maxIter=MAX_ITER, regParam=REG_PARAM, elasticNetParam=ELASTIC_NET_PARAM, family="multinomial", **cols
        )
    raise ValueError(f"unknown classifier {kind!r}")


def _features(spec: TuningSpec, num_features: int, prefix: str) -> tuple[HashingTF, IDF]:
    htf = HashingTF(inputCol=spec.feature_col, outputCol=f"{prefix}tf_features", numFeatures=num_features)
    return htf, IDF(inputCol=f"{prefix}tf_features", outputCol=f"{prefix}features")


def fold_of(id_col: str, folds: int, seed: int = CV_SEED) -> F.Column:
    """Fold number (0 .. folds - 1) of a row, from its id alone."""
    return hash_unit(id_col, seed) % F.lit(folds)


@dataclass
class CollectionModel:
    """``kind`` ``constant``: the training rows held one class, ``label``."""

    collection_id: str
    kind: str
    model: PipelineModel | None
    cv_auc: float | None
    all_auc: dict[str, float | None]
    label: float | None = None
    folds: int = 0


def _regularisations(spec: TuningSpec, kind: str) -> list[float | None]:
    return list(spec.reg_params) if kind in ("logistic", "multinomial") else [None]


# A cell's weights and intercepts; ``reg`` numbers the regularisations.
_CELLS = "collection_id string, num_features int, fold int, reg int, idx int, idf double, weights array<double>"
_CELL_HEADS = "collection_id string, num_features int, fold int, reg int, intercepts array<double>"
_CELL = ["collection_id", "num_features", "fold", "reg"]
#: Entries of the vectors (12 bytes each) that a task of a fit goes through.
TASK_ENTRIES = 1 << 22


def _hashed(training: DataFrame, spec: TuningSpec) -> DataFrame:
    """Training rows with their fold and vectors, written by collection."""
    rows = training.select("collection_id", F.col("label").cast("double").alias("label"), fold_of("id", spec.num_folds, spec.seed).cast("int").alias("fold"), F.monotonically_increasing_id().alias("row"), spec.feature_col)
    return hashed_vectors(rows, spec.num_features, spec.feature_col, "hashed", ["collection_id"])


def hashed_training(training: DataFrame, spec: TuningSpec) -> DataFrame:
    """The vectors of training rows, for several ``train_collections`` of one
    grid (hash sizes, folds and seed)."""
    return _hashed(training, spec)


def _part_idfs(frequencies: DataFrame, cid: str, rows: dict[int, int]) -> dict[tuple[int, int], np.ndarray]:
    """IDF vector of every (hash size, left-out fold) of a collection: at most
    folds x sizes numbers an index, whatever the number of texts."""
    own = frequencies.filter(F.col("collection_id") == cid).groupBy("num_features", "fold", "idx").agg(F.sum("df").alias("df")).toArrow()
    size, fold, idx, df = (own.column(c).to_numpy() for c in ("num_features", "fold", "idx", "df"))
    out = {}
    for n in np.unique(size).tolist():
        counts = np.zeros((max(rows) + 1, n))
        here = size == n
        counts[fold[here], idx[here]] = df[here]
        for f in rows:
            m = sum(rows.values()) - rows[f]
            out[n, f] = np.log((m + 1.0) / (counts.sum(axis=0) - counts[f] + 1.0))
    return out


def _fit_tasks(frequencies: DataFrame) -> dict[str, dict[int, int]]:
    """Tasks of a fit by collection and hash size."""
    entries = frequencies.groupBy("collection_id", "num_features").agg(F.sum("df").alias("n"))
    out: dict[str, dict[int, int]] = {}
    for r in entries.toLocalIterator():
        out.setdefault(r[0], {})[r[1]] = -(-r[2] // TASK_ENTRIES)
    return out


def _fit_cells(kind: str, prefix: str, spec: TuningSpec, hashed: DataFrame, frequencies: DataFrame, counts: dict, usable: dict, concurrency: int) -> tuple[DataFrame, DataFrame]:
    """(weights, heads) of every cell of all collections, by Spark's fits.

    A fit's rows lie in as many partitions as their entries fill, and as many
    fits run at once as the cores have tasks for: many tiny ones, or two
    of a collection that fills all cores by itself.  What they keep in memory
    is bounded by the cores, not by the number of fits."""
    spark = hashed.sparkSession
    sink = WeightSink(spark, f"{work_folder(spark)}/cells-{uuid.uuid4().hex}", _CELLS)
    heads: list[tuple] = []
    idfs: dict[str, dict] = {}
    lock = threading.Lock()

    def idf_of_part(cid: str, n: int, fold: int) -> np.ndarray:
        with lock:
            if cid not in idfs:
                idfs[cid] = _part_idfs(frequencies, cid, {f: sum(own.values()) for f, own in counts[cid].items()})
        return idfs[cid].get((n, fold), np.zeros(n))

    def unit(cid: str, n: int, tasks: int, at_once: int) -> None:
        part = hashed.filter(F.col("collection_id") == cid).select("label", "fold", f"tf_{n}", "row")
        part = (part.coalesce(1) if tasks < 2 else part.repartition(tasks, "row")).drop("row").persist(StorageLevel.MEMORY_AND_DISK)

        def cell(fold: int) -> None:
            idf = idf_of_part(cid, n, fold)
            scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol=f"tf_{n}", outputCol=f"{prefix}features")
            train = scale.transform(part.filter(F.col("fold") != fold).select("label", f"tf_{n}")).select("label", f"{prefix}features")
            for k, reg in enumerate(_regularisations(spec, kind)):
                clf = _classifier(kind, prefix)
                intercepts, classes = coefficients(kind, (clf.copy({clf.regParam: reg}) if reg is not None else clf).fit(train))
                sink.add({"collection_id": cid, "num_features": n, "fold": fold, "reg": k}, idf, classes)
                heads.append((cid, n, fold, k, intercepts.tolist()))

        try:
            with ThreadPoolExecutor(max_workers=at_once) as pool:
                list(pool.map(inheritable_thread_target(spark)(cell), usable[cid]))
        finally:
            part.unpersist()

    # fits in flight at most, for fits of one task; wider ones are fewer
    most = max(2, concurrency * max(1, spec.parallelism))
    tasks = _fit_tasks(frequencies)
    waves: dict[int, list[tuple[str, int, int]]] = {}
    for cid in sorted(usable):
        for n in spec.num_features if usable[cid] else ():
            wide = max(1, tasks.get(cid, {}).get(n, 1))
            waves.setdefault(wide.bit_length(), []).append((cid, n, wide))
    for bits in sorted(waves, reverse=True):
        fits = max(2, most >> (bits - 1))
        inner = min(fits, spec.num_folds)
        with ThreadPoolExecutor(max_workers=max(1, fits // inner)) as pool:
            list(pool.map(inheritable_thread_target(spark)(lambda u, k=inner: unit(*u, k)), waves[bits]))
    return sink.table().select(*_CELL, "idx", F.transform("weights", lambda w: w * F.col("idf")).alias("weights")), spark.createDataFrame(heads, _CELL_HEADS)


def _entry_counts(hashed: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """``collection_id, df``: entries of the vectors, row by row."""
    return hashed.select("collection_id", reduce(add, [F.size(F.unwrap_udt(f"tf_{n}")["indices"]) for n in sizes]).cast("long").alias("df"))


def _logistic_cells(spec: TuningSpec, hashed: DataFrame, frequencies: DataFrame, counts: dict, usable: dict, multinomial: bool = False) -> tuple[DataFrame, DataFrame]:
    """(weights, heads) of every regression's cell of all collections, by rounds
    that all cells share (``grid_fits``).  A collection's rows are dealt over
    as many parts as its entries (the sums of ``df``) fill."""
    spark = hashed.sparkSession
    entries = materialize(frequencies.groupBy("collection_id").agg(F.sum("df").alias("n")), "entries")
    deals = entries.select("collection_id", F.ceil(F.col("n") * 8 / F.lit(TASK_ENTRIES)).cast("int").alias("parts"))
    all_entries = entries.agg(F.sum("n")).first()[0] or 0
    tasks = max(2, 2 * spark.sparkContext.defaultParallelism, -(-all_entries // TASK_ENTRIES))
    packed = grid_fits.blocks(hashed, spec.num_features, tasks, deals)
    sink = WeightSink(spark, f"{work_folder(spark)}/cells-{uuid.uuid4().hex}", _CELLS)
    heads: list[tuple] = []
    for cid, n, fold, k, idf, intercepts, weights in grid_fits.fit_cells(packed, counts, usable, spec.num_features, spec.reg_params, ELASTIC_NET_PARAM, MAX_ITER, multinomial):
        sink.add({"collection_id": cid, "num_features": n, "fold": fold, "reg": k}, idf, weights)
        heads.append((cid, n, fold, k, intercepts.tolist()))
    return sink.table().select(*_CELL, "idx", F.transform("weights", lambda w: w * F.col("idf")).alias("weights")), spark.createDataFrame(heads, _CELL_HEADS)


def bayes_cells(frequencies: DataFrame, rows: DataFrame, smoothing: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(weights, heads) of naive Bayes for every (collection, hash size,
    left-out fold) without a fit: sums of the collection less the fold's own.
    ``rows``: training rows (``collection_id, fold, label, n``) by fold and
    class.  The weights are the positive class's, as its raw score ranks."""
    positive = F.col("label") == 1.0
    by = ["collection_id", "num_features", "idx"]
    own = frequencies.groupBy(*by, "fold").agg(F.sum("df").alias("df"), F.sum(F.when(positive, F.col("tf")).otherwise(0.0)).alias("s1"))
    total = own.groupBy(*by).agg(F.sum("df").alias("all_df"), F.sum("s1").alias("all_s1"))
    folds = rows.groupBy("collection_id", "fold").agg(F.sum("n").alias("n"), F.sum(F.when(positive, F.col("n")).otherwise(0)).alias("n1"))
    whole = folds.groupBy("collection_id").agg(F.sum("n").alias("all_n"), F.sum("n1").alias("all_n1"))
    parts = folds.join(whole, "collection_id").select("collection_id", "fold", (F.col("all_n") - F.col("n")).alias("n"), (F.col("all_n1") - F.col("n1")).alias("n1"))
    left = attach_small(total, parts, "collection_id").join(own, [*by, "fold"], "left")
    idf = idf_of("n", F.col("all_df") - F.coalesce("df", F.lit(0)))
    sums = left.select(*by, "fold", idf.alias("idf"), (idf * (F.col("all_s1") - F.coalesce("s1", F.lit(0.0)))).alias("s1"))
    sums = materialize(sums, "bayes-sums")
    log_all = sums.groupBy("collection_id", "num_features", "fold").agg(F.ln(F.sum("s1") + F.col("num_features") * F.lit(smoothing)).alias("log_all"))
    weight = F.col("idf") * (F.ln(F.col("s1") + F.lit(smoothing)) - F.col("log_all"))
    weights = attach_small(sums, log_all, ["collection_id", "num_features", "fold"]).select("collection_id", "num_features", "fold", F.lit(0).alias("reg"), "idx", F.array(weight).alias("weights"))
    prior = F.ln(F.col("n1") + F.lit(smoothing)) - F.ln(F.col("n") + F.lit(2 * smoothing))
    heads = parts.join(log_all.select("collection_id", "num_features", "fold"), ["collection_id", "fold"])
    return weights, heads.select("collection_id", "num_features", "fold", F.lit(0).alias("reg"), F.array(prior).alias("intercepts"))


def _held_out_scores(hashed: DataFrame, weights: DataFrame, heads: DataFrame, sizes: Sequence[int], width: int) -> DataFrame:
    """Raw scores of every row by the cells that left its fold out:
    ``collection_id, num_features, fold, reg, label, raw_0 ..``."""
    terms = exploded_entries(hashed, sizes, ("collection_id", "fold", "row"))
    joined = terms.join(weights, ["collection_id", "num_features", "fold", "idx"])
    sums = joined.groupBy("row", *_CELL).agg(*[F.sum(F.col("tf") * F.get("weights", F.lit(c))).alias(f"s_{c}") for c in range(width)])
    every = attach_small(hashed.select("collection_id", "fold", "row", "label"), heads, ["collection_id", "fold"])
    scored = every.join(sums, ["row", *_CELL], "left")
    return scored.select(*_CELL, "label", *[(F.get("intercepts", F.lit(c)) + F.coalesce(f"s_{c}", F.lit(0.0))).alias(f"raw_{c}") for c in range(width)])


def _cell_metrics(kind: str, hashed: DataFrame, weights: DataFrame, heads: DataFrame, spec: TuningSpec) -> dict[str, dict]:
    """Metric of every cell, by collection and (fold, hash size, reg): grid
    and folds bound the rows of a collection."""
    width = 1
    if kind == "multinomial":
        width = heads.agg(F.max(F.size("intercepts"))).first()[0] or 1
    scored = _held_out_scores(hashed, weights, heads, spec.num_features, width)
    if kind == "multinomial":
        raws = F.array_compact(F.array(*[f"raw_{c}" for c in range(width)]))
        first = F.array_position(raws, F.array_max(raws)).cast("double") - 1.0
        metric = weighted_f1(scored.withColumn("prediction", first), _CELL).withColumnRenamed("f1", "metric")
    else:
        metric = area_under_roc(scored, _CELL, "raw_0").withColumnRenamed("auc", "metric")
    out: dict[str, dict] = {}
    for r in metric.select(*_CELL, "metric").toLocalIterator():
        out.setdefault(r[0], {})[r[2], r[1], r[3]] = r[4]
    return out


def _best(spec: TuningSpec, kind: str, metrics: dict, usable: list[int]) -> tuple[tuple[int, float | None], float | None]:
    """The cell of the best mean over the usable folds (the first of equals;
    without any usable fold the first cell, without a metric)."""
    regs = _regularisations(spec, kind)
    best, best_mean = (spec.num_features[0], regs[0]), None
    for n in spec.num_features:
        for k, reg in enumerate(regs):
            mean = sum(metrics[f, n, k] for f in usable) / len(usable) if usable else None
            if mean is not None and (best_mean is None or mean > best_mean):
                best, best_mean = (n, reg), mean
    return best, best_mean


def _usable_folds(own: dict[int, dict]) -> list[int]:
    """Folds whose held-out and remaining rows both hold several classes: on
    others a metric says nothing."""
    return [f for f in sorted(own) if len(own[f]) > 1 and len(set().union(*(c for g, c in own.items() if g != f))) > 1]


def default_concurrency(spark) -> tuple[int, int]:
    """(collections trained at once, fits per collection at once)."""
    cores = max(1, spark.sparkContext.defaultParallelism)
    return max(1, cores // 2), max(1, min(8, cores))


def train_collections(
    training: DataFrame,
    spec: TuningSpec | None = None,
    concurrency: int | None = None,
    prefix: str = "",
    hashed: DataFrame | None = None,
) -> dict[str, CollectionModel]:
    """One model per collection of ``training`` (materialised and partitioned
    by ``collection_id`` so each fit reads only its files); a collection of one
    class gets a constant one.  ``hashed``: the rows' vectors
    (``hashed_training``), where they are there already.

    Only the rows' counts by (collection, fold, class) and what the fits leave
    there come to the driver."""
    spark = training.sparkSession
    conc, par = default_concurrency(spark)
    spec, conc = spec or TuningSpec(parallelism=par), max(1, concurrency or conc)
    rows = training.filter("collection_id IS NOT NULL").groupBy("collection_id", fold_of("id", spec.num_folds, spec.seed).cast("int").alias("fold"), F.col("label").cast("double").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    rows = materialize(rows, "fold-rows")
    counts: dict[str, dict[int, dict]] = {}
    for r in rows.toLocalIterator():
        counts.setdefault(r[0], {}).setdefault(r[1], {})[r[2]] = r[3]
    classes = {cid: sorted(set().union(*own.values())) for cid, own in counts.items()}
    several = [cid for cid in sorted(classes) if len(classes[cid]) > 1]
    usable = {cid: _usable_folds(counts[cid]) for cid in several}
    metrics: dict[str, dict[str, dict]] = {}
    if any(usable.values()):
        hashed = _hashed(training, spec) if hashed is None else hashed
        for kind in spec.classifiers:
            if kind == "naive_bayes":
                cells = bayes_cells(materialize(fold_frequencies(hashed, spec.num_features), "frequencies", ["collection_id"]), rows)
            else:
                cells = _logistic_cells(spec, hashed, _entry_counts(hashed, spec.num_features), counts, usable, kind == "multinomial")
            metrics[kind] = _cell_metrics(kind, hashed, *cells, spec)

    def run(cid: str) -> CollectionModel:
        if len(classes[cid]) < 2:
            return CollectionModel(cid, "constant", None, None, {}, label=classes[cid][0])
        found = {kind: _best(spec, kind, metrics.get(kind, {}).get(cid, {}), usable[cid]) for kind in spec.classifiers}
        worth = lambda kind: found[kind][1] if found[kind][1] is not None else -1.0
        kind = max(spec.classifiers, key=worth)  # the first of equals
        (num_features, reg), mean = found[kind]
        clf = _classifier(kind, prefix)
        clf = clf.copy({clf.regParam: reg}) if reg is not None else clf
        htf, idf = _features(spec, num_features, prefix)
        if usable[cid]:  # its vectors are there
            rows = hashed.filter(F.col("collection_id") == cid).select("label", F.col(f"tf_{num_features}").alias(f"{prefix}tf_features"))
            model = PipelineModel([htf, *Pipeline(stages=[idf, clf]).fit(rows).stages])
        else:
            model = Pipeline(stages=[htf, idf, clf]).fit(training.filter(F.col("collection_id") == cid))
        return CollectionModel(cid, kind, model, mean, {k: v[1] for k, v in found.items()}, folds=len(usable[cid]))

    # each worker thread starts with the caller's Spark local properties
    # (job group, tags, pools)
    with ThreadPoolExecutor(max_workers=max(conc, min(spec.parallelism, 8))) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(run), sorted(classes)))
    return {m.collection_id: m for m in results}


def as_table(models: dict[str, CollectionModel] | ModelTable, rows: DataFrame) -> ModelTable:
    return models if isinstance(models, ModelTable) else model_table(rows.sparkSession, models)


def apply_models(
    models: dict[str, CollectionModel] | ModelTable,
    rows: DataFrame,
    prefix: str = "",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Each collection's model on that collection's rows: ``id,
    collection_id, *keep, <prefix>prediction, <prefix>probability_relevant,
    status``, one row per input row."""
    raw = raw_scores([as_table(models, rows)], rows, keep)
    c = class_scores(F.col("raw_0"), F.col("label_0"))
    relevant = F.coalesce(F.get(c["probability"], F.lit(1)), F.col("label_0"))
    return raw.select("id", "collection_id", *keep, c["prediction"].alias(f"{prefix}prediction"), relevant.alias(f"{prefix}probability_relevant"), c["status"].alias("status"))


def score(models: dict[str, CollectionModel] | ModelTable, testing: DataFrame) -> DataFrame:
    """``id, collection_id, prediction, probability_relevant, status`` for
    every text."""
    return apply_models(models, testing)


def apply_multiclass(models: dict[str, CollectionModel] | ModelTable, rows: DataFrame) -> DataFrame:
    """``id, collection_id, prediction`` (class index), the probability of the
    predicted class, and ``status``, for every row."""
    raw = raw_scores([as_table(models, rows)], rows)
    c = class_scores(F.col("raw_0"), F.col("label_0"))
    sure = F.coalesce(F.array_max(c["probability"]), F.when(F.col("label_0").isNotNull(), F.lit(1.0)))
    return raw.select("id", "collection_id", c["prediction"].alias("prediction"), sure.alias("probability_predicted"), c["status"].alias("status"))


def ensemble(
    first: dict[str, CollectionModel] | ModelTable,
    second: dict[str, CollectionModel] | ModelTable,
    testing: DataFrame,
) -> DataFrame:
    """Average the relevance probabilities of two model sets for every text;
    where only one set knows the collection, its probability counts alone.
    Both tables are joined with the same terms in one pass."""
    raw = raw_scores([as_table(first, testing), as_table(second, testing)], testing)
    own = [class_scores(F.col(f"raw_{k}"), F.col(f"label_{k}")) for k in (0, 1)]
    p = [F.coalesce(F.get(c["probability"], F.lit(1)), F.col(f"label_{k}")) for k, c in enumerate(own)]
    scored = raw.select("id", "collection_id", p[0].alias("p_first"), p[1].alias("p_second"), *[c["status"].alias(f"_s{k}") for k, c in enumerate(own)])
    avg = F.coalesce((F.col("p_first") + F.col("p_second")) / 2.0, "p_first", "p_second")
    status = F.when((F.col("_s0") == "trained") | (F.col("_s1") == "trained"), "trained").when(avg.isNotNull(), "one_class").otherwise("untrained")
    prediction = F.when(avg > 0.5, 1.0).when(avg.isNotNull(), 0.0)
    return scored.select("id", "collection_id", "p_first", "p_second", avg.alias("probability_relevant"), prediction.alias("prediction"), status.alias("status"))


def model_summary(models: dict[str, CollectionModel]) -> list[tuple]:
    """Small per-collection table of the chosen models (for reports):
    collection, kind, metric, hash size, folds."""
    return [
        (cid, m.kind, m.cv_auc, None if m.model is None else int(m.model.stages[0].getNumFeatures()), m.folds)
        for cid, m in sorted(models.items())
    ]
