"""The two phases from the command line on tab-separated files."""

import glob
import json

import pytest

from relevo.__main__ import main
from relevo.sources.models import load_models
from relevo.streaming.scoring import read_scores

STAMP = "20240506-070809"


def _folder(root, cid):
    d = root / f"z_{cid}"
    d.mkdir(parents=True)
    lines = [f"{cid}-{i}\tBrass band plays street music near bridge {i}" if i % 2 else f"{cid}-{i}\tQuiet garden with apple trees number{i}" for i in range(40)]
    (d / "part-0").write_text("\n".join([*lines, "broken line without tab"]) + "\n")


def test_mine_and_predict(spark, tmp_path, capsys):
    root, out, cfg = tmp_path / "data", tmp_path / "out", tmp_path / "cfg.json"
    for cid in ("0071", "new-town"):
        _folder(root, cid)
    own = [{"Id": cid, "name": f"name of {cid}", "FP": ["street", "music"]} for cid in ("0071", "new-town", "999")]
    cfg.write_text(json.dumps({"collections": own}))
    common = ["--config", str(cfg), "--lines", str(root), "--out", str(out), "--run-ts", STAMP]
    assert main(["mine", *common]) == 0
    assert "collection 999" in capsys.readouterr().err
    for cid in ("0071", "new-town"):
        files = glob.glob(str(out / f"patterns/lines/collection_id={cid}/run_ts={STAMP}/*.txt"))
        assert "20 music street" in "".join(open(f).read() for f in files)
    assert main(["predict", *common, "--num-folds", "2", "--num-features", "64", "--reg-params", "0.01"]) == 0
    assert spark.read.parquet(str(out / "score_cells")).count() == 80
    preds = spark.read.option("sep", "\t").option("header", True).csv(str(out / "predictions"))
    assert preds.count() == 80 and "Probability" in preds.columns
    names = {r.output_name for r in spark.read.json(str(out / "names")).collect()}
    assert f"{STAMP}_0071_name of 0071" in names
    assert set(load_models(spark, str(out / f"models/run_ts={STAMP}"))) == {"0071", "new-town"}
    # scoring with the saved models gives the same scores, from files and from a stream
    want = {(r.row_key, r.value) for r in spark.read.parquet(str(out / f"score_cells/run_ts={STAMP}")).collect()}
    saved = ["--models", str(out / f"models/run_ts={STAMP}")]
    assert main(["score", *saved, *common[:4], "--out", str(tmp_path / "again"), "--run-ts", "20240507-000000"]) == 0
    got = {(r.row_key, float(r.value)) for r in spark.read.parquet(str(tmp_path / "again/score_cells")).collect()}
    assert dict(got) == pytest.approx({k: float(v) for k, v in want}, abs=1e-9)
    texts = tmp_path / "texts"
    rows = [(f"0071-{i}", "Brass band plays street music") for i in range(5)]
    spark.createDataFrame(rows, "id string, text string").write.parquet(str(texts))
    stream = ["score", *saved, "--texts", str(texts), "--out", str(tmp_path / "live"), "--stream"]
    assert main(stream) == 0
    spark.createDataFrame([("9-1", "unknown")], "id string, text string").write.mode("append").parquet(str(texts))
    assert main(stream) == 0  # goes on behind what it has read
    live = {r.id: r.status for r in read_scores(spark, str(tmp_path / "live/scores")).collect()}
    assert len(live) == 6 and live["9-1"] == "untrained" and live["0071-3"] == "trained"
    # histograms of the newest files
    assert main(["histogram", "--predictions", str(out / "predictions"), "--out", str(out)]) == 0
    bins = spark.read.json(str(out / "histograms")).groupBy("collection_id").sum("n").collect()
    assert {r[0]: r[1] for r in bins} == {"0071": 40, "new-town": 40}
    # one folder of text files, and no input at all
    assert main(["mine", "--config", str(cfg), "--lines", str(root / "z_0071"), "--out", str(out / "one"), "--run-ts", STAMP]) == 0
    assert main(["mine", "--config", str(cfg), "--lines", str(tmp_path / "absent"), "--out", str(out)]) == 0


def test_modes_tell_what_they_need(tmp_path):
    for argv in (["mine", "--texts", "x"], ["score", "--texts", "x"], ["histogram"], ["predict", "--config", "c"], ["mine", "--config", "c", "--texts", "x", "--stream"]):
        with pytest.raises(SystemExit):
            main([*argv, "--out", str(tmp_path)])
