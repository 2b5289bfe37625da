"""The queries of this subpackage and the SQL that expresses them."""

from __future__ import annotations

from tabulon.llm.decontaminate import OP3_SQL, op3_decontaminate
from tabulon.llm.language_id import op7_language_id
from tabulon.llm.lm_scoring import op9_lm_scoring
from tabulon.llm.neighbours import op6_neighbours
from tabulon.llm.packing import op10_packing
from tabulon.llm.simhash import op5_simhash
from tabulon.llm.substring_dedup import op2_substring_dedup
from tabulon.llm.suffix_dedup import op8_suffix_dedup
from tabulon.llm.token_counts import op1_token_counts
from tabulon.llm.token_store import op4_token_files

QUERIES = {f.__name__: f for f in (op1_token_counts, op2_substring_dedup, op3_decontaminate, op4_token_files, op5_simhash, op6_neighbours, op7_language_id, op8_suffix_dedup, op9_lm_scoring, op10_packing)}
ORACLE: dict[str, str] = {"op3_decontaminate": OP3_SQL}
