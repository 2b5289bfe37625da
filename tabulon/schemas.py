"""Explicit schemas; nothing is inferred, so a company called TRUE stays a string."""

from __future__ import annotations

EXTRACTED = (
    "company string, source string, statement string, unit string, page string, section string, item_raw string, item_used string, "
    "concept string, concept_eq string, match_score double, con_cur double, con_prev double, sep_cur double, sep_prev double"
)
CELLS = "company string, source string, page int, unit string, side string, block int, row_index int, item string, col_index int, equity_component string, is_total_col boolean, kind string, value double"
TRUTH = "company string, unit string, page string, section string, item string, con_cur string, con_prev string, sep_cur string, sep_prev string, trap string, _concept_hint string, _note string"
MATRIX_TRUTH = "company string, unit string, page int, item string, col_index int, value double"
ALIAS = "concept string, alias string, note string"
BOXES = "source string, page int, text string, x int, y int, w int, h int, conf double"
PAGES = "source string, page int, text string"
