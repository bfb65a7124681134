"""Cells fitted in common rounds equal the library's fits of each cell."""

import random

import pytest
from pyspark.sql import functions as F

from relevo.operators import grid_fits, model
from relevo.operators.features import fold_frequencies
from relevo.operators.model import TuningSpec, train_collections

SPEC = TuningSpec(num_features=(10, 60), reg_params=(0.1, 0.01), num_folds=2, parallelism=4)
TRAINING = "id string, collection_id string, filtered array<string>, label double"


@pytest.fixture(scope="module")
def training(spark):
    pick = random.Random(5)
    rows = []
    for cid, n in (("a", 60), ("b", 37), ("o'c", 25)):
        for i in range(n):
            label = float(pick.random() < 0.4)
            words = [f"w{pick.randrange(40)}" for _ in range(pick.randrange(12))] + ["every"]
            words += ["storm"] * pick.randrange(1, 3) if label and pick.random() < 0.8 else []
            rows.append((f"{cid}-{i}", cid, words if i % 11 else [], label))
        rows.append((f"{cid}-null", cid, None, 0.0))
    rows += [("z-1", "z", ["one", "class"], 1.0), ("z-2", "z", ["one"], 1.0)]
    return spark.createDataFrame(rows, TRAINING).cache()


def _cells(made):
    weights, heads = made
    w = {tuple(r)[:5]: r.weights[0] for r in weights.collect() if r.weights[0] != 0}
    return w, {tuple(r)[:4]: r.intercepts[0] for r in heads.collect()}


def test_cells_equal_the_librarys_fits(spark, training, monkeypatch):
    hashed = model._hashed(training, SPEC)
    frequencies = fold_frequencies(hashed, SPEC.num_features).cache()
    counts: dict = {}
    for r in hashed.groupBy("collection_id", "fold", "label").agg(F.count(F.lit(1)).alias("n")).collect():
        counts.setdefault(r.collection_id, {}).setdefault(r.fold, {})[r.label] = r.n
    usable = {cid: model._usable_folds(own) for cid, own in counts.items()}
    assert usable["a"] and not usable["z"]
    want = _cells(model._fit_cells("logistic", "", SPEC, hashed, frequencies, counts, usable, 4))
    assert any(abs(w) > 0.1 for w in want[0].values())
    for entries, numbers in ((grid_fits.BLOCK_ENTRIES, grid_fits.POINT_NUMBERS), (40, 500)):  # one batch, two
        monkeypatch.setattr(grid_fits, "BLOCK_ENTRIES", entries)
        monkeypatch.setattr(grid_fits, "POINT_NUMBERS", numbers)
        got = _cells(model._logistic_cells(SPEC, hashed, frequencies, counts, usable))
        assert got[0] == pytest.approx(want[0], abs=1e-9)
        assert got[1] == pytest.approx(want[1], abs=1e-9)


def test_tuning_takes_no_fit_a_cell(spark, training, monkeypatch):
    fits = []
    fit = model.LogisticRegression._fit
    monkeypatch.setattr(model.LogisticRegression, "_fit", lambda self, rows: fits.append(1) or fit(self, rows))
    models = train_collections(training.filter("filtered IS NOT NULL"), SPEC, concurrency=2)
    assert len(fits) == sum(m.model is not None for m in models.values()) == 3  # each chosen cell's own
    assert all(m.cv_auc is not None for m in models.values() if m.folds)


@pytest.mark.parametrize("dense", [1000, 0])
def test_multinomial_cells_equal_the_librarys_fits(spark, training, monkeypatch, dense):
    """Several classes, one of them in a single fold (so that a part lacks it),
    unpacked blocks and blocks gone through by index."""
    several = training.filter("collection_id <> 'z'").withColumn("label", F.when(F.array_contains("filtered", "w7"), 2.0).when((F.col("collection_id") == "b") & (F.col("id") == "b-3"), 3.0).otherwise(F.col("label")))
    hashed = model._hashed(several, SPEC)
    frequencies = fold_frequencies(hashed, SPEC.num_features).cache()
    counts: dict = {}
    for r in hashed.groupBy("collection_id", "fold", "label").agg(F.count(F.lit(1)).alias("n")).collect():
        counts.setdefault(r.collection_id, {}).setdefault(r.fold, {})[r.label] = r.n
    assert sum(3.0 in own for own in counts["b"].values()) == 1
    usable = {cid: model._usable_folds(own) for cid, own in counts.items()}
    read = lambda made: ({(*tuple(r)[:5], c): x for r in made[0].collect() for c, x in enumerate(r.weights) if x}, {(*tuple(r)[:4], c): x for r in made[1].collect() for c, x in enumerate(r.intercepts)})
    want = read(model._fit_cells("multinomial", "", SPEC, hashed, frequencies, counts, usable, 4))
    monkeypatch.setattr(grid_fits, "DENSE", dense)
    got = read(model._logistic_cells(SPEC, hashed, model._entry_counts(hashed, SPEC.num_features), counts, usable, multinomial=True))
    assert any(abs(w) > 0.1 for w in want[0].values())
    assert got[0] == pytest.approx(want[0], abs=1e-9)
    assert got[1] == pytest.approx(want[1], abs=1e-9)


def test_multinomial_tuning_takes_no_fit_a_cell(spark, training, monkeypatch):
    fits = []
    fit = model.LogisticRegression._fit
    monkeypatch.setattr(model.LogisticRegression, "_fit", lambda self, rows: fits.append(1) or fit(self, rows))
    several = training.filter("filtered IS NOT NULL").withColumn("label", F.when(F.array_contains("filtered", "w7"), 2.0).otherwise(F.col("label")))
    models = train_collections(several, TuningSpec(num_features=(10, 60), reg_params=(0.1, 0.01), num_folds=2, classifiers=("multinomial",)), concurrency=2)
    assert len(fits) == sum(m.model is not None for m in models.values()) == 3
    assert all(m.cv_auc is not None for m in models.values() if m.folds)
