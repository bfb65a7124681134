"""Command line: the two phases of the relevance job, scoring with saved models
and histograms of prediction files.

    python -m relevo mine      --config cfg.json INPUT --out OUT
    python -m relevo predict   --config cfg.json INPUT --out OUT
    python -m relevo score     --models OUT/models/run_ts=STAMP [--config cfg.json] INPUT --out OUT [--stream]
    python -m relevo histogram --predictions OUT/predictions [--run-ts STAMP] --out OUT

INPUT is one of ``--lines DIR``, ``--cells PATH``, ``--texts PATH``.
``--lines``: tab-separated text files (``<collection>-<id> TAB text``), either
one folder of them or a root with a folder ``z_<id>`` for each collection
(absent ones are skipped and named);
``--cells``: Parquet with ``row_key, cells`` (JSON cells joined by newlines);
``--texts``: Parquet with ``id, text`` (raw text).  ``mine`` writes pattern
files and item sets; ``predict`` writes score cells, prediction files and the
fitted models.  Both write the run's output names.  ``score`` writes score
cells and prediction files of saved models, with ``--stream`` the scores of
what has newly arrived in the ``--texts`` folder since its last run.
``histogram`` reads each collection's newest prediction files (or those of one
stamp).  What a run writes in between is deleted when it ends.
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from relevo.functions.text import clean_text, collection_of
from relevo.operators.model import GRID_NUM_FEATURES, GRID_REG_PARAM, NUM_FOLDS, TuningSpec, default_concurrency
from relevo.plans.jobs import classify, file_histograms, mine_patterns
from relevo.session import get_session, materialize, workspace
from relevo.sources import cells_to_texts, load_cells, parse_lines, read_collections, read_config, read_lines
from relevo.sources.cells import select_collections
from relevo.sources.models import load_table
from relevo.sources.sinks import write_predictions_tsv, write_run_names, write_score_cells
from relevo.streaming.scoring import score_batch, start_scoring


def _texts(spark: SparkSession, args, config: DataFrame | None) -> DataFrame | None:
    if args.lines:
        if config is None:
            lines = read_lines(spark, args.lines)
            return None if lines is None else parse_lines(lines)
        ids = [r[0] for r in config.select("collection_id").distinct().orderBy("collection_id").collect()]
        lines, absent = read_collections(spark, args.lines, ids)
        if lines is None:
            lines = read_lines(spark, args.lines)
        else:
            for cid in absent:
                print(f"collection {cid}: no folder below {args.lines}, skipped", file=sys.stderr)
        return None if lines is None else parse_lines(lines)
    if args.cells:
        return cells_to_texts(load_cells(spark.read.parquet(args.cells)))
    return _table_texts(spark.read.parquet(args.texts))


def _table_texts(raw: DataFrame) -> DataFrame:
    return raw.select("id", collection_of("id").alias("collection_id"), clean_text("text").alias("text"))


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="relevo")
    p.add_argument("mode", choices=["mine", "predict", "score", "histogram"])
    p.add_argument("--config")
    src = p.add_mutually_exclusive_group()
    src.add_argument("--lines")
    src.add_argument("--cells")
    src.add_argument("--texts")
    src.add_argument("--predictions")
    p.add_argument("--models")
    p.add_argument("--stream", action="store_true")
    p.add_argument("--out", required=True)
    p.add_argument("--min-support", type=float, default=0.02)
    p.add_argument("--run-ts", default=None, help="run stamp yyyyMMdd-HHmmss (default: now)")
    p.add_argument("--num-folds", type=int, default=NUM_FOLDS)
    p.add_argument("--num-features", type=int, nargs="+", default=list(GRID_NUM_FEATURES))
    p.add_argument("--reg-params", type=float, nargs="+", default=list(GRID_REG_PARAM))
    args = p.parse_args(argv)
    texts = args.lines or args.cells or args.texts
    if args.mode == "histogram" and not args.predictions:
        p.error("histogram needs --predictions")
    if args.mode != "histogram" and not texts:
        p.error("one of --lines, --cells and --texts is needed")
    if args.mode in ("mine", "predict") and not args.config:
        p.error(f"{args.mode} needs --config")
    if args.mode == "score" and not args.models:
        p.error("score needs --models")
    if args.stream and not (args.mode == "score" and args.texts):
        p.error("--stream goes with score and --texts")
    return args


def _write_scores(scores: DataFrame, out: str, run_ts: str) -> None:
    write_score_cells(scores, f"{out}/score_cells/run_ts={run_ts}")
    write_predictions_tsv(scores, f"{out}/predictions", run_ts)


def _score(spark: SparkSession, args, run_ts: str) -> int:
    models = load_table(spark, args.models)
    if args.stream:
        schema = spark.read.parquet(args.texts).schema
        texts = _table_texts(spark.readStream.schema(schema).parquet(args.texts))
        start_scoring(texts, models, f"{args.out}/scores", f"{args.out}/checkpoint").awaitTermination()
        return 0
    config = read_config(spark, args.config) if args.config else None
    texts = _texts(spark, args, config)
    if texts is None:
        return _nothing(args)
    if config is not None:
        texts = select_collections(texts, config.select("collection_id"))
    _write_scores(materialize(score_batch(texts, models), "scores"), args.out, run_ts)
    return 0


def _nothing(args) -> int:
    print(f"no input at {args.lines}; nothing to do", file=sys.stderr)
    return 0


def _run(spark: SparkSession, args, run_ts: str) -> int:
    if args.mode == "histogram":
        file_histograms(spark, args.predictions, args.run_ts).write.mode("overwrite").json(f"{args.out}/histograms")
        return 0
    if args.mode == "score":
        return _score(spark, args, run_ts)
    config = read_config(spark, args.config)
    texts = _texts(spark, args, config)
    if texts is None:
        return _nothing(args)
    write_run_names(config, f"{args.out}/names", run_ts)
    if args.mode == "mine":
        mine_patterns(texts, config, min_support=args.min_support, out_path=f"{args.out}/patterns", run_ts=run_ts)
    else:
        spec = TuningSpec(
            num_features=tuple(args.num_features),
            reg_params=tuple(args.reg_params),
            num_folds=args.num_folds,
            parallelism=default_concurrency(spark)[1],
        )
        run = classify(texts, config, spec, models_path=f"{args.out}/models/run_ts={run_ts}")
        _write_scores(run.scores(), args.out, run_ts)
        run.training_error().write.mode("overwrite").json(f"{args.out}/training_error/run_ts={run_ts}")
    return 0


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = get_session()
    with workspace(spark):
        return _run(spark, args, args.run_ts or time.strftime("%Y%m%d-%H%M%S"))


if __name__ == "__main__":
    raise SystemExit(main())
