"""Model properties: probabilities in [0, 1], one score per text, better
than chance on a separable fixture, repeatable with the same seed."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from relevo.operators import model
from relevo.operators.model import TuningSpec, apply_models, ensemble, score, train_collections
from relevo.operators.report import relevance_share, training_error
from relevo.plans.jobs import score_histograms
from relevo.sources.sinks import read_predictions_tsv, score_cells, write_predictions_tsv

SMALL = TuningSpec(num_features=(64, 1024), reg_params=(0.1, 0.01), num_folds=2, parallelism=4)


def _training(spark):
    rows = []
    for cid in ("a", "b"):
        for i in range(30):
            pos = i % 2 == 0
            words = ["storm", "flood", "river", f"w{i % 5}"] if pos else ["music", "party", "dance", f"w{i % 5}"]
            rows.append((f"{cid}-{i}", cid, words, 1.0 if pos else 0.0))
    return spark.createDataFrame(rows, "id string, collection_id string, filtered array<string>, label double")


@pytest.fixture(scope="module")
def trained(spark):
    train = _training(spark).cache()
    return train, train_collections(train, SMALL, concurrency=2)


def test_scores_are_probabilities_one_per_id(spark, trained):
    train, models = trained
    assert set(models) == {"a", "b"}
    s = score(models, train.select("id", "collection_id", "filtered"))
    rows = s.collect()
    assert len(rows) == train.count() == len({r.id for r in rows})
    assert all(0.0 <= r.probability_relevant <= 1.0 for r in rows)


def test_better_than_chance(spark, trained):
    train, models = trained
    pred = apply_models(models, train, keep=("label",)).withColumn("raw", F.col("probability_relevant"))
    auc = BinaryClassificationEvaluator(rawPredictionCol="raw").evaluate(pred)
    assert auc > 0.9
    assert all(m.cv_auc > 0.5 for m in models.values())


def test_same_seed_same_scores(spark, trained):
    train, models = trained
    again = train_collections(train, SMALL, concurrency=2)
    a = {r.id: r.probability_relevant for r in score(models, train).collect()}
    b = {r.id: r.probability_relevant for r in score(again, train).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_every_text_gets_a_row(spark, trained):
    train, models = trained
    rows = [(f"z-{i}", "z", ["x", "y"], 1.0) for i in range(6)]
    single = spark.createDataFrame(rows, "id string, collection_id string, filtered array<string>, label double")
    models = {**models, **train_collections(single, SMALL, concurrency=1)}
    assert models["z"].kind == "constant" and models["z"].label == 1.0
    other = spark.createDataFrame([("q-1", "q", ["x"], 0.0), ("n-1", None, None, 0.0)], single.schema)
    out = {r.id: r for r in score(models, train.unionByName(single).unionByName(other)).collect()}
    assert len(out) == train.count() + 8
    assert out["z-0"].status == "one_class" and out["z-0"].prediction == out["z-0"].probability_relevant == 1.0
    assert out["q-1"].status == out["n-1"].status == "untrained" and out["q-1"].probability_relevant is None
    assert out["a-0"].status == "trained"
    both = ensemble(models, {"a": models["z"]}, train.filter("collection_id = 'b'").unionByName(other)).collect()
    assert len(both) == 32 and {r.id: r.status for r in both}["q-1"] == "untrained"
    assert score({}, other).count() == 2


def test_layout_does_not_change_models(spark, trained):
    train, models = trained
    want = {r.id: r.probability_relevant for r in score(models, train).collect()}
    for other in (train.repartition(7), train.coalesce(1)):
        again = train_collections(other, SMALL, concurrency=2)
        assert {c: m.cv_auc for c, m in again.items()} == pytest.approx({c: m.cv_auc for c, m in models.items()})
        got = {r.id: r.probability_relevant for r in score(again, train).collect()}
        assert got == pytest.approx(want, abs=1e-9)


def test_fits_of_many_tasks_equal_those_of_one(spark, trained, monkeypatch):
    train, models = trained
    want = {r.id: r.probability_relevant for r in score(models, train).collect()}
    monkeypatch.setattr(model, "TASK_ENTRIES", 20)
    persisted = []
    frame = type(train)
    repartition = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, n, *cols: persisted.append(n) or repartition(self, n, *cols))
    again = train_collections(train, SMALL, concurrency=2)
    assert persisted and min(persisted) > 1  # a collection's rows are dealt over tasks by their entries
    assert {c: m.cv_auc for c, m in again.items()} == pytest.approx({c: m.cv_auc for c, m in models.items()})
    got = {r.id: r.probability_relevant for r in score(again, train).collect()}
    assert got == pytest.approx(want, abs=1e-9)


def test_scoring_sorts_no_terms(spark, trained):
    train, models = trained
    plan = score(models, train)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_folds_of_one_class_do_not_count(spark):
    rows = [(f"f-{i}", "f", ["good" if i < 3 else "bad", f"w{i}"], 1.0 if i < 3 else 0.0) for i in range(12)]
    df = spark.createDataFrame(rows, "id string, collection_id string, filtered array<string>, label double")
    m = train_collections(df, SMALL, concurrency=1)["f"]
    assert m.model is not None and 0 <= m.folds <= SMALL.num_folds
    assert (m.cv_auc is None) == (m.folds == 0)


def test_saved_models_load(spark, trained, tmp_path):
    from relevo.sources.models import load_models, save_models

    train, models = trained
    path = str(tmp_path / "models")
    save_models(models, path)
    back = load_models(spark, path)
    assert {c: (m.kind, m.cv_auc, m.folds) for c, m in back.items()} == {c: (m.kind, m.cv_auc, m.folds) for c, m in models.items()}
    a = {r.id: r.probability_relevant for r in score(models, train).collect()}
    assert a == {r.id: r.probability_relevant for r in score(back, train).collect()}


def test_reports_and_sinks(spark, trained, tmp_path):
    train, models = trained
    preds = apply_models(models, train, keep=("label",))
    stats = train.groupBy("collection_id").agg(F.count(F.lit(1)).alias("n_texts"))
    err = {r.collection_id: r for r in training_error(preds, stats).collect()}
    assert all(r.error_all_texts <= r.error_training + 1e-12 for r in err.values())
    s = score(models, train)
    share = {r.collection_id: r for r in relevance_share(s).collect()}
    assert all(r.n_texts == 30 for r in share.values())
    hist = score_histograms(s).groupBy("collection_id").agg(F.sum("n").alias("n")).collect()
    assert all(r.n == 30 for r in hist)
    cells = score_cells(s).collect()
    assert {(c.column_family, c.qualifier) for c in cells} == {("classification", "probability2")}
    write_predictions_tsv(s.withColumn("collection_id", F.col("collection_id")), str(tmp_path / "p"), "20160101-000000")
    back = read_predictions_tsv(spark, str(tmp_path / "p"))
    assert back.count() == 60 and "Probability" in back.columns


def test_ensemble_averages_two_model_sets(spark, trained):
    train, models = trained
    nb = train_collections(train, TuningSpec(num_features=(64,), num_folds=2, classifiers=("naive_bayes",)), concurrency=2, prefix="nb_")
    e = ensemble(models, nb, train.select("id", "collection_id", "filtered")).collect()
    assert len(e) == 60
    assert all(abs(r.probability_relevant - (r.p_first + r.p_second) / 2) < 1e-12 for r in e)


def test_save_and_load_model(spark, trained, tmp_path):
    from relevo.operators.model import CollectionModel
    from relevo.sources.sinks import load_model, save_model

    train, models = trained
    path = str(tmp_path / "model_a")
    save_model(models["a"].model, path)
    back = {"a": CollectionModel("a", "logistic", load_model(path), models["a"].cv_auc, {})}
    rows = train.filter(F.col("collection_id") == "a")
    x = {r.id: r.probability_relevant for r in score({"a": models["a"]}, rows).collect()}
    y = {r.id: r.probability_relevant for r in score(back, rows).collect()}
    assert x == y


def test_multiclass_labels_and_model(spark):
    from relevo.operators.labeling import multiclass_training_set
    from relevo.operators.model import apply_multiclass
    from relevo.operators.preprocess import prepare_texts

    rows = []
    for i in range(60):
        k = i % 3
        text = ["storm flood river", "music party dance", "nothing else here"][k] + f" word{i % 4}"
        rows.append((f"m-{i}", "m", text))
    df = spark.createDataFrame(rows, "id string, collection_id string, text string")
    classes = F.array(F.lit("storm flood"), F.lit("music party"))
    prepared = prepare_texts(df).withColumn("pattern", classes)
    t = multiclass_training_set(prepared)
    labels = {r.id: r.label for r in t.collect()}
    assert all(labels[f"m-{i}"] == float(i % 3 + 1) for i in range(60) if i % 3 < 2)
    assert all(labels.get(f"m-{i}", 0.0) == 0.0 for i in range(60) if i % 3 == 2)
    spec = TuningSpec(num_features=(64,), reg_params=(0.01,), num_folds=2, classifiers=("multinomial",))
    models = train_collections(t, spec, concurrency=1)
    out = apply_multiclass(models, prepared.select("id", "collection_id", F.col("words").alias("filtered"))).collect()
    assert len(out) == 60
    assert all(0.0 <= r.probability_predicted <= 1.0 for r in out)
    acc = sum(1 for r in out if int(r.id.split("-")[1]) % 3 < 2 and r.prediction == int(r.id.split("-")[1]) % 3 + 1)
    assert acc >= 35
