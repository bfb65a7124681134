"""Scans and sinks."""

from relevo.sources.cells import cells_to_texts, explode_cells, key_prefix_filter, load_cells, select_collections
from relevo.sources.config import config_for_texts, config_from_rows, read_config
from relevo.sources.lines import parse_lines, read_collections, read_lines
from relevo.sources.sinks import (
    pattern_lines,
    read_predictions_tsv,
    save_model,
    score_cells,
    write_patterns,
    write_predictions_tsv,
    write_run_names,
    write_score_cells,
)

__all__ = [
    "cells_to_texts",
    "config_for_texts",
    "config_from_rows",
    "explode_cells",
    "key_prefix_filter",
    "load_cells",
    "parse_lines",
    "pattern_lines",
    "read_collections",
    "read_config",
    "read_lines",
    "read_predictions_tsv",
    "save_model",
    "score_cells",
    "select_collections",
    "write_patterns",
    "write_predictions_tsv",
    "write_run_names",
    "write_score_cells",
]
