"""Sparse features, fold statistics, exact ranking and model tables against
the library's own estimators."""

import math
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, IDF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from relevo.operators import model as M
from relevo.operators.features import fold_frequencies, fold_idf, hash_tokens, hashed_idf, term_frequencies, tf_idf
from relevo.operators.model_table import ModelTable, model_table, naive_bayes_table
from relevo.operators.ranking import area_under_roc, numbered, weighted_f1

ROWS = "id string, collection_id string, filtered array<string>, label double"


def _texts(n=60, collections=("a", "b", "c"), seed=7):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["über", "日本語", "", "x" * 300, "abcd", "abcde"]
    out = []
    for c in collections:
        for i in range(n):
            label = float(rng.random() < 0.4)
            own = ["flood", "river"] if label and rng.random() < 0.8 else ["party", "music"] if rng.random() < 0.7 else []
            out.append((f"{c}-{i}", c, own + [rng.choice(words) for _ in range(rng.randint(0, 9))], label))
    return out


@pytest.fixture(scope="module")
def training(spark):
    return spark.createDataFrame(_texts(), ROWS).repartition(4).cache()


@pytest.mark.parametrize("size", [16, 100, 262144])
def test_rows_equal_the_librarys_vectors(spark, training, size):
    odd = training.unionByName(spark.createDataFrame([("n-1", "a", None, 0.0), ("n-2", "a", [], 1.0)], ROWS))
    got = {(r.id, r.idx): r.tf for r in term_frequencies(odd, size).collect()}
    vectors = HashingTF(inputCol="filtered", outputCol="v", numFeatures=size).transform(training).select("id", "v").collect()
    assert got == {(r.id, int(i)): x for r in vectors for i, x in zip(r.v.indices, r.v.values, strict=True)}


def test_tf_idf_equals_the_librarys(spark, training):
    other = spark.createDataFrame([("a-new", "a", ["flood", "never", "seen"], 0.0), ("z-1", "z", ["flood"], 0.0)], ROWS)
    rows = training.unionByName(other)
    got = {(r.id, r.idx): r.tf_idf for r in tf_idf(rows, training, 100).collect()}
    assert got.pop(("z-1", HashingTF(numFeatures=100, inputCol="filtered").indexOf("flood"))) is None
    want = {}
    for c in ("a", "b", "c"):
        stages = [HashingTF(inputCol="filtered", outputCol="tf", numFeatures=100), IDF(inputCol="tf", outputCol="v")]
        for r in Pipeline(stages=stages).fit(training.filter(F.col("collection_id") == c)).transform(rows.filter(F.col("collection_id") == c)).collect():
            want |= {(r.id, int(i)): x for i, x in zip(r.v.indices, r.v.values, strict=True)}
    assert got == pytest.approx(want, abs=1e-12)
    assert hashed_idf(training, 100).filter("df < 1 OR idf IS NULL").count() == 0


def test_several_hash_sizes_are_one_pass_over_the_rows(spark, training, tmp_path):
    training.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    odd = spark.createDataFrame([("n-1", "a", None, 0.0), ("n-2", "a", [], 0.0), (None, None, ["flood"], 0.0), ("a-1", "a", ["flood", "flood"], 0.0), ("z-1", "z", ["flood"], 0.0)], ROWS)
    both = tf_idf(rows.unionByName(odd), training, (100, 64))
    order = ["id", "collection_id", "num_features", "idx", "tf", "idf", "tf_idf"]
    got = sorted(map(repr, both.select(*order).collect()))
    alone = [tf_idf(rows.unionByName(odd), training, n).withColumn("num_features", F.lit(n)).select(*order) for n in (100, 64)]
    assert got == sorted(map(repr, alone[0].unionByName(alone[1]).collect()))
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(_tokens") == 2 and "lambdafunction" not in plan  # one vector a size, unrolled as it is


def test_terms_of_folds_and_held_out_rows_are_unrolled_as_they_are(spark, training):
    hashed = hash_tokens(training.select("collection_id", "label", M.fold_of("id", 3).cast("int").alias("fold"), F.monotonically_increasing_id().alias("row"), "filtered"), (20, 64))
    weights, heads = spark.createDataFrame([], M._CELLS.replace(" idf double,", "")), spark.createDataFrame([("a", 20, 0, 0, [0.5])], M._CELL_HEADS)
    scored = M._held_out_scores(hashed, weights, heads, (20, 64), 1)
    for df in (fold_frequencies(hashed, (20, 64)), scored):
        assert "lambdafunction" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.fold, r.raw_0) for r in scored.collect()} == {(0, 0.5)}


def test_fold_idf_equals_fits_on_the_rest(spark, training):
    hashed = hash_tokens(training.withColumn("fold", M.fold_of("id", 3).cast("int")), (20, 64)).cache()
    n_rows = hashed.groupBy("collection_id", "fold").agg(F.count(F.lit(1)).alias("n_rows"))
    got = {(r.collection_id, r.num_features, r.fold, r.idx): (r.df, r.idf) for r in fold_idf(fold_frequencies(hashed, (20, 64)), n_rows).collect()}
    for c in ("a", "c"):
        for n in (20, 64):
            for f in range(3):
                part = hashed.filter((F.col("collection_id") == c) & (F.col("fold") != f))
                idf = IDF(inputCol=f"tf_{n}", outputCol="v").fit(part)
                for i, (df, x) in enumerate(zip(idf.docFreq, idf.idf, strict=True)):
                    assert got.get((c, n, f, i), (0, x)) == (df, pytest.approx(x, abs=1e-12))


def test_area_under_roc_equals_the_unbinned_evaluator(spark):
    rng = random.Random(2)
    rows = [(g, round(rng.gauss(0, 1) + y * 0.5, 1 if g == "ties" else 6) + 0.0, float(y)) for g, n in (("ties", 3000), ("many", 2500), ("few", 7)) for y in (rng.randint(0, 1) for _ in range(n))]
    rows += [("zero", s, y) for s, y in ((0.0, 1.0), (-0.0, 0.0), (0.5, 1.0))] + [("one", 0.5, 1.0)] * 4 + [("few", None, 1.0), ("few", 0.3, None)]
    df = spark.createDataFrame(rows, "g string, score double, label double").repartition(5)
    got = {r.g: r for r in area_under_roc(df, ["g"]).collect()}
    assert got["one"].auc is None and (got["one"].n_positive, got["one"].n_negative) == (4, 0)
    assert got["zero"].auc == 0.75
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    for g in ("ties", "many", "few"):
        assert got[g].auc == pytest.approx(evaluator.evaluate(df.filter(F.col("g") == g).na.drop()), abs=1e-12)


def test_weighted_f1_equals_the_evaluator(spark):
    rng = random.Random(4)
    rows = [(g, float(rng.randint(0, 3)), float(rng.randint(0, 4))) for g in "pq" for _ in range(200)]
    df = spark.createDataFrame(rows, "g string, label double, prediction double")
    got = {r.g: r.f1 for r in weighted_f1(df, ["g"]).collect()}
    for g in "pq":
        assert got[g] == pytest.approx(MulticlassClassificationEvaluator(metricName="f1").evaluate(df.filter(F.col("g") == g)), abs=1e-12)


def test_numbers_follow_the_order(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot"] * 8 + ["cold", None]), rng.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(6)
    got = numbered(df, ["g"], [F.desc("v"), "i"]).collect()
    want = {}
    for g in {r[0] for r in rows}:
        for k, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])), 1):
            want[r[2]] = k
    assert {r.i: r.number for r in got} == want


def _by_library(models, rows, relevant=True):
    out = {}
    for c, m in models.items():
        scored = m.model.transform(rows.filter(F.col("collection_id") == c))
        for r in scored.select("id", "prediction", vector_to_array("probability").alias("p")).collect():
            out[r.id] = (r.prediction, r.p[1] if relevant else max(r.p))
    return out


@pytest.mark.parametrize("kind", ["logistic", "naive_bayes"])
def test_table_scores_equal_each_models_transform(spark, training, kind, tmp_path):
    spec = M.TuningSpec(num_features=(16, 128), reg_params=(0.05, 0.01), num_folds=2, classifiers=(kind,))
    models = M.train_collections(training, spec, concurrency=3)
    rows = training.unionByName(spark.createDataFrame([("a-n", "a", ["never", "seen"], 0.0), ("b-e", "b", [], 0.0)], ROWS))
    want = _by_library(models, rows)
    model_table(spark, models).save(str(tmp_path / "t"))
    table = ModelTable.load(spark, str(tmp_path / "t"))
    got = {r.id: (r.prediction, r.probability_relevant) for r in M.score(table, rows).collect()}
    assert got.keys() == want.keys()
    for i, (prediction, p) in want.items():
        assert got[i][1] == pytest.approx(p, abs=1e-9)
        assert got[i][0] == prediction or abs(p - 0.5) < 1e-9


def test_multiclass_table_equals_transform(spark):
    rng = random.Random(1)
    rows = [(f"m-{i}", "m", [["storm", "music", "law"][i % 3] if rng.random() < 0.8 else "other", f"w{rng.randint(0, 9)}"], float(i % 3)) for i in range(90)]
    df = spark.createDataFrame(rows, ROWS)
    models = M.train_collections(df, M.TuningSpec(num_features=(32,), reg_params=(0.01,), num_folds=2, classifiers=("multinomial",)), concurrency=1)
    want = _by_library(models, df, relevant=False)
    got = {r.id: (r.prediction, r.probability_predicted) for r in M.apply_multiclass(models, df).collect()}
    assert all(got[i] == (p, pytest.approx(x, abs=1e-9)) for i, (p, x) in want.items())


def test_bayes_from_one_aggregate_equals_the_library(spark, training):
    one = spark.createDataFrame([(f"s-{i}", "s", ["x"], 1.0) for i in range(3)], ROWS)
    table = naive_bayes_table(training.unionByName(one), 50)
    rows = training.unionByName(one).unionByName(spark.createDataFrame([("a-n", "a", ["never", "seen"], 0.0), ("q-1", "q", ["x"], 0.0)], ROWS))
    got = {r.id: r for r in M.score(table, rows).collect()}
    assert got["s-0"].status == "one_class" and got["s-0"].probability_relevant == 1.0 and got["q-1"].status == "untrained"
    for c in ("a", "b", "c"):
        stages = [HashingTF(inputCol="filtered", outputCol="tf", numFeatures=50), IDF(inputCol="tf", outputCol="features"), NaiveBayes(modelType="multinomial")]
        fitted = Pipeline(stages=stages).fit(training.filter(F.col("collection_id") == c))
        for r in fitted.transform(rows.filter(F.col("collection_id") == c)).select("id", vector_to_array("probability").alias("p")).collect():
            assert got[r.id].probability_relevant == pytest.approx(r.p[1], abs=1e-9)


@pytest.mark.parametrize("kind", ["logistic", "naive_bayes"])
def test_cell_metrics_equal_fits_with_the_library(spark, training, kind):
    """What the folds' subtraction, the cells' weights and the exact ranking
    give is what IDF, fit, transform and evaluator give one by one."""
    spec = M.TuningSpec(num_features=(64,), reg_params=(0.02,), num_folds=3, classifiers=(kind,))
    models = M.train_collections(training, spec, concurrency=3)
    for c in ("a", "b"):
        own = training.filter(F.col("collection_id") == c).withColumn("fold", M.fold_of("id", 3))
        metrics = []
        for f in range(3):
            stages = [HashingTF(inputCol="filtered", outputCol="tf", numFeatures=64), IDF(inputCol="tf", outputCol="features"), M._classifier(kind)]
            if kind == "logistic":
                stages[2] = stages[2].copy({stages[2].regParam: 0.02})
            fitted = Pipeline(stages=stages).fit(own.filter(F.col("fold") != f))
            metrics.append(BinaryClassificationEvaluator(numBins=0).evaluate(fitted.transform(own.filter(F.col("fold") == f))))
        assert models[c].cv_auc == pytest.approx(math.fsum(metrics) / 3, abs=1e-6)


def _plan(models, spark, n):
    rows = spark.createDataFrame([(f"c{i}-1", f"c{i}", ["x"], 0.0) for i in range(n)], ROWS)
    return len(M.score(models, rows)._jdf.queryExecution().optimizedPlan().toString().split("\n"))


def test_plan_does_not_grow_with_collections(spark, training):
    models = M.train_collections(training, M.TuningSpec(num_features=(16,), reg_params=(0.1,), num_folds=2), concurrency=3)
    many = {f"{c}{k}": M.CollectionModel(f"{c}{k}", m.kind, m.model, m.cv_auc, {}) for c, m in models.items() for k in range(30)}
    assert _plan(models, spark, 3) == _plan(many, spark, 90)


def test_vectors_of_sizes_that_divide_another_are_folded(spark):
    """Equal to the library's vectors, though only 60 and 7 are hashed to."""
    from pyspark.ml.feature import HashingTF

    from relevo.operators import features

    rows = spark.createDataFrame([(1, ["a", "b", "a", "c"] + [f"w{i}" for i in range(50)]), (2, []), (3, None), (4, ["x"])], "id long, words array<string>").coalesce(1)
    hashed_to, plain = [], features.hash_tokens
    features.hash_tokens = lambda rows, sizes, col: hashed_to.extend(sizes) or plain(rows, sizes, col)
    try:
        got = features.hashed_vectors(rows, (10, 60, 7, 20), "words", "folded", ["id"]).orderBy("id").collect()
    finally:
        features.hash_tokens = plain
    assert hashed_to == [60, 7]
    known = rows.fillna({}).selectExpr("id", "coalesce(words, array()) words")
    for n in (10, 60, 7, 20):
        want = HashingTF(inputCol="words", outputCol="v", numFeatures=n).transform(known).orderBy("id").collect()
        assert [r[f"tf_{n}"] for r in got] == [r.v for r in want]
