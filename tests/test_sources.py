"""Config, tab lines and wide-column cells (FIXTURES §4)."""

import json
import os

from pyspark.sql import functions as F

from relevo.sources import (
    cells_to_texts,
    config_from_rows,
    key_prefix_filter,
    load_cells,
    parse_lines,
    read_config,
    read_lines,
    select_collections,
)

HERE = os.path.dirname(os.path.abspath(__file__))


def test_read_config(spark):
    cfg = read_config(spark, os.path.join(HERE, "fixtures", "collections_config.json"))
    rows = {r["collection_id"]: r for r in cfg.collect()}
    assert len(rows) == 4
    assert rows["71"]["name"] == "street music "
    assert rows["71"]["pattern"] == ["music", "street", "brass"]
    assert rows["0071"]["type"] == rows["305"]["type"] == "binary" and rows["305"]["pattern"] == []


def test_parse_lines_arity(spark):
    lines = [
        ("712-1\tHello world again",),
        ("no tab here",),
        ("712-2\tone\ttwo",),
        ("712-3\t",),
        ("  712-4\tpadded text  ",),
    ]
    got = parse_lines(spark.createDataFrame(lines, "value string")).collect()
    assert [(r.id, r.collection_id, r.text) for r in got] == [
        ("712-1", "712", "Hello world again"),
        ("712-4", "712", "padded text"),
    ]


def test_read_lines_missing_and_present(spark, tmp_path):
    assert read_lines(spark, str(tmp_path / "z_999")) is None
    d = tmp_path / "z_712"
    d.mkdir()
    (d / "part-0").write_text("712-1\tsome text here\n712-2\tmore text here\n")
    df = read_lines(spark, str(d))
    assert sorted(r.id for r in parse_lines(df).collect()) == ["712-1", "712-2"]


def _cells(*objs):
    return "\n".join(json.dumps(o) for o in objs)


def test_cells_families_and_qualifiers(spark):
    rows = [
        (
            "712-1",
            _cells(
                {"columnFamily": "collection-management", "qualifier": "text", "value": "First text here"},
                {"columnFamily": "metadata", "qualifier": "lang", "value": "en"},
                {"columnFamily": "collection-management", "qualifier": "other", "value": "Second one here"},
            ),
        ),
        ("712-2", _cells({"columnFamily": "metadata", "qualifier": "lang", "value": "fr"})),
    ]
    cells = load_cells(spark.createDataFrame(rows, "row_key string, cells string"))
    got = sorted((r.id, r.text) for r in cells_to_texts(cells).collect())
    assert got == [("712-1", "First text here"), ("712-1", "Second one here")]
    only = cells_to_texts(cells, qualifier="text").collect()
    assert [(r.id, r.text) for r in only] == [("712-1", "First text here")]


def test_prefix_raw_and_delimited(spark):
    texts = spark.createDataFrame(
        [("712-1", "a"), ("71-2", "b"), ("7123-3", "c")], "id string, text string"
    )
    cfg = config_from_rows(spark, [{"Id": "71", "name": "x", "FP": []}, {"Id": "712", "name": "y", "FP": []}])
    delim = sorted((r.collection_id, r.id) for r in select_collections(texts, cfg).collect())
    assert delim == [("71", "71-2"), ("712", "712-1")]
    raw = sorted((r.collection_id, r.id) for r in select_collections(texts, cfg, delimited=False).collect())
    assert raw == [("71", "71-2"), ("71", "712-1"), ("71", "7123-3"), ("712", "712-1"), ("712", "7123-3")]
    assert texts.filter(key_prefix_filter("id", "71", delimited=False)).count() == 3
    assert texts.filter(key_prefix_filter("id", "71")).count() == 1


def test_prefix_filter_reaches_parquet_scan(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.createDataFrame([("712-1", "a")], "id string, text string").write.parquet(p)
    plan = spark.read.parquet(p).filter(key_prefix_filter("id", "712"))._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(id,712-)" in plan


def test_ids_that_hold_the_separator(spark):
    texts = spark.createDataFrame([("new-town-1", "a"), ("new-2", "b"), ("newer-3", "c"), ("x", "d"), (None, "e")], "id string, text string")
    cfg = config_from_rows(spark, [{"Id": "new-town", "FP": []}, {"Id": "new", "FP": []}])
    got = sorted((r.collection_id, r.id) for r in select_collections(texts, cfg).collect())
    assert got == [("new", "new-2"), ("new-town", "new-town-1")]  # the longest id has the text
    assert select_collections(texts, cfg.limit(0)).count() == 0


def test_materialised_ids_keep_their_text(spark):
    from relevo.session import materialize

    df = spark.createDataFrame([("007", 1), ("7", 2), (None, 3)], "collection_id string, n int")
    back = materialize(df, "ids", ["collection_id"])
    assert back.schema["collection_id"].dataType.simpleString() == "string"
    assert sorted(((r.collection_id, r.n) for r in back.collect()), key=repr) == [("007", 1), ("7", 2), (None, 3)]


def test_outputs_keep_other_runs_and_collections(spark, tmp_path):
    from relevo.sources import read_predictions_tsv, write_patterns, write_predictions_tsv, write_run_names, write_score_cells

    def scores(cid, p):
        return spark.createDataFrame([(f"{cid}-1", cid, p)], "id string, collection_id string, probability_relevant double")

    path = str(tmp_path / "predictions")
    for cid, stamp, p in (("007", "r1", 0.1), ("7", "r1", 0.2), ("007", "r2", 0.3), ("007", "r2", 0.4)):
        write_predictions_tsv(scores(cid, p), path, stamp)
    got = sorted((r.collection_id, r.run_ts, r.Probability) for r in read_predictions_tsv(spark, path).collect())
    assert got == [("007", "r1", 0.1), ("007", "r2", 0.4), ("7", "r1", 0.2)]
    for _ in range(2):
        write_score_cells(scores("7", 0.5), str(tmp_path / "cells"))
    assert spark.read.parquet(str(tmp_path / "cells")).count() == 1
    sets = spark.createDataFrame([("7", ["a"], 2), ("7", ["b"], 3), ("8", ["c"], 1)], "collection_id string, items array<string>, freq long")
    write_patterns(sets, str(tmp_path / "patterns"), "r1")
    write_patterns(sets.filter("collection_id = '7'"), str(tmp_path / "patterns"), "r2")
    lines = spark.read.text(str(tmp_path / "patterns/lines")).collect()
    assert sorted((str(r.collection_id), r.run_ts, r.value) for r in lines) == [("7", "r1", "2 a"), ("7", "r1", "3 b"), ("7", "r2", "2 a"), ("7", "r2", "3 b"), ("8", "r1", "1 c")]
    cfg = config_from_rows(spark, [{"Id": "007", "name": "own name", "FP": []}])
    write_run_names(cfg, str(tmp_path / "names"), "r1")
    assert [r.output_name for r in spark.read.json(str(tmp_path / "names")).collect()] == ["r1_007_own name"]


def test_config_sizes_are_checked_before_broadcast(spark):
    texts = spark.createDataFrame([("712-1", "a")], "id string, text string")
    cfg = config_from_rows(spark, [{"Id": "712", "name": "y", "FP": []}])
    plan = select_collections(texts, cfg)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert F is not None


def test_spread_only_what_cannot_be_split(spark):
    from relevo.session import spread

    wide = spark.range(0, 1000, numPartitions=2)
    assert spread(wide) is wide
    out = spread(spark.range(0, 1000, numPartitions=1))
    assert out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in out.collect()) == list(range(1000))


def test_longest_configured_id_has_the_text(spark):
    from relevo.sources.cells import select_collections

    keys = ["new-1", "new-york-1", "new-york-city-7", "newer-2", "new-", "new", "york-1", None, "a-b-1", "a-1"]
    texts = spark.createDataFrame([(k, "old", "t") for k in keys], "id string, collection_id string, text string")
    config = spark.createDataFrame([("new", 1), ("new-york", 2), ("new-york-city", 3), ("a-b", 4)], "collection_id string, n int")
    got = {(r.id, r.collection_id, r.n) for r in select_collections(texts, config).collect()}
    assert got == {("new-1", "new", 1), ("new-york-1", "new-york", 2), ("new-york-city-7", "new-york-city", 3), ("new-", "new", 1), ("a-b-1", "a-b", 4)}
    raw = sorted((r.id, r.collection_id) for r in select_collections(texts, config, delimited=False).collect())
    assert ("newer-2", "new") in raw and ("new-york-1", "new") in raw and ("new-york-1", "new-york") in raw


def test_newest_prediction_files(spark, tmp_path):
    from relevo.plans.jobs import file_histograms
    from relevo.sources.sinks import newest_predictions, write_predictions_tsv

    path = str(tmp_path / "p")
    rows = [(f"{c}-{i}", c, i / 10) for c in ("007", "a b/c=d%+", "x") for i in range(5)]
    df = spark.createDataFrame(rows, "id string, collection_id string, probability_relevant double")
    write_predictions_tsv(df, path, "20240101-000000")
    write_predictions_tsv(df.filter("collection_id <> 'x'").withColumn("probability_relevant", F.col("probability_relevant") + 1), path, "20240202-000000")
    got = newest_predictions(spark, path)
    assert {(r.collection_id, r.run_ts) for r in got.collect()} == {("007", "20240202-000000"), ("a b/c=d%+", "20240202-000000"), ("x", "20240101-000000")}
    assert got.count() == 15 and got.filter("collection_id = '007'").agg(F.min("Probability")).first()[0] == 1.0
    assert {r.run_ts for r in file_histograms(spark, path, "20240101-000000").collect()} == {"20240101-000000"}


def test_a_run_leaves_nothing_behind(spark, tmp_path):
    import os
    import uuid

    from relevo.session import abandoned_runs, checkpoint_dir, materialize, publish, release, work_folder, workspace

    root = checkpoint_dir(spark).removeprefix("file:").rstrip("/")
    df = spark.range(10)
    with workspace(spark) as folder:
        assert work_folder(spark) == folder and materialize(df, "x").count() == 10
        assert sorted(os.listdir(folder))[-1].startswith("x-") and os.path.exists(f"{folder}/manifest.json")
    assert not os.path.exists(folder)
    try:
        with workspace(spark) as failed:
            materialize(df, "y")
            raise ValueError
    except ValueError:
        pass
    assert not os.path.exists(failed)
    kept = materialize(df, "z")
    others = {f for f, _ in abandoned_runs(spark)}
    assert kept.count() == 10 and not any(work_folder(spark).rsplit("/", 1)[1] in f for f in others)
    old = f"{root}/relevo/run-old-{uuid.uuid4().hex}"
    os.makedirs(old)
    with open(f"{old}/manifest.json", "w") as f:
        f.write('{"application": "gone", "started": "2024-01-01T00:00:00Z"}')
    assert [m["application"] for f, m in abandoned_runs(spark) if f not in others] == ["gone"]
    own = work_folder(spark).removeprefix("file:")
    assert os.path.exists(own)
    release(spark)
    assert not os.path.exists(own) and os.path.exists(old)
    for n in (1, 2):
        df.limit(n).write.parquet(str(tmp_path / f"part{n}"))
        publish(spark, str(tmp_path / f"part{n}"), str(tmp_path / "out"))
        assert spark.read.parquet(str(tmp_path / "out")).count() == n
    assert sorted(os.listdir(tmp_path)) == ["out"]
