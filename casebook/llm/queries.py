"""The registered queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casebook.llm.contrast_lm import op4_contrast_lm
from casebook.llm.conversation_trie import OP13_SQL, op13_prefix_trie
from casebook.llm.decision_list import op9_decision_list
from casebook.llm.factor_machine import op5_factorization_machine
from casebook.llm.filter_cascade import OP6_SQL, op6_filter_cascade
from casebook.llm.fm_dedup import OP11_SQL, op11_fm_index
from casebook.llm.hard_negatives import OP12_SQL, op12_rotated_codes
from casebook.llm.lsh_forest import OP7_SQL, op7_lsh_forest
from casebook.llm.nn_descent import op1_nn_descent
from casebook.llm.pattern_packing import op10_pattern_packing
from casebook.llm.source_schedule import op8_source_schedule
from casebook.llm.suffix_dedup import op3_suffix_dedup
from casebook.llm.token_prefixes import op2_prefix_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nn_descent": op1_nn_descent,
    "op2_prefix_counts": op2_prefix_counts,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_contrast_lm": op4_contrast_lm,
    "op5_factorization_machine": op5_factorization_machine,
    "op6_filter_cascade": op6_filter_cascade,
    "op7_lsh_forest": op7_lsh_forest,
    "op8_source_schedule": op8_source_schedule,
    "op9_decision_list": op9_decision_list,
    "op10_pattern_packing": op10_pattern_packing,
    "op11_fm_index": op11_fm_index,
    "op12_rotated_codes": op12_rotated_codes,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {"op6_filter_cascade": OP6_SQL, "op7_lsh_forest": OP7_SQL, "op11_fm_index": OP11_SQL, "op12_rotated_codes": OP12_SQL, "op13_prefix_trie": OP13_SQL}
