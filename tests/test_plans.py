"""Plan shape of the registered queries: no cartesian or nested-loop joins,
broadcast only behind a size check, scans pruned to the needed columns."""

import pytest

from relevo.plans.queries import SQL_CHECKED


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(SQL_CHECKED))
def test_no_cartesian_or_nested_loop(spark, sf_small, name):
    plan = _plan(SQL_CHECKED[name](spark, sf_small))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_positive_share_prunes_columns_and_broadcasts_config(spark, sf_small):
    plan = _plan(SQL_CHECKED["positive_share"](spark, sf_small))
    assert "BroadcastHashJoin" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in plan
    assert "n_chars" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_term_idf_uses_partial_aggregation(spark, sf_small):
    plan = _plan(SQL_CHECKED["term_idf"](spark, sf_small))
    assert "partial_count" in plan
    assert "Subquery" in plan or "subquery" in plan


def test_label_queries_write_and_shuffle_no_text(spark, sf_small):
    from relevo.plans.queries import flagged_documents

    flagged = flagged_documents(spark, sf_small)
    assert flagged.columns == ["id", "collection_id", "is_positive", "is_candidate", "n_features"]
    plan = _plan(SQL_CHECKED["training_set"](spark, sf_small))
    assert "text" not in plan and "filtered" not in plan


def test_second_classifier_hashes_no_rows_again(spark, sf_small, monkeypatch):
    from relevo.operators import model
    from relevo.plans import model_queries

    hashed, plain = [], model.hashed_vectors
    monkeypatch.setattr(model, "hashed_vectors", lambda *a: hashed.append(1) or plain(*a))
    model_queries.release_runs()
    assert model_queries.q_ensemble_scores(spark, sf_small).count()
    assert len(hashed) == 1
