"""Queries of the subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from . import phrase_mining, quality_rules, va_search
from .best_fit import op10_best_fit
from .byte_bpe import op1_byte_bpe
from .html_text import op4_html_text
from .language_id import op6_language_id
from .phrase_mining import op13_phrase_mining
from .quality_rules import op3_quality_rules
from .sim_hash import op7_sim_hash
from .subword_lm import op5_subword_lm
from .suffix_array import op2_suffix_array
from .token_align import op11_token_align
from .token_counts import op8_token_counts
from .toxicity import op12_toxicity
from .va_search import op9_va_search

QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_suffix_array": op2_suffix_array,
    "op3_quality_rules": op3_quality_rules,
    "op4_html_text": op4_html_text,
    "op5_subword_lm": op5_subword_lm,
    "op6_language_id": op6_language_id,
    "op7_sim_hash": op7_sim_hash,
    "op8_token_counts": op8_token_counts,
    "op9_va_search": op9_va_search,
    "op10_best_fit": op10_best_fit,
    "op11_token_align": op11_token_align,
    "op12_toxicity": op12_toxicity,
    "op13_phrase_mining": op13_phrase_mining,
}

ORACLE: dict[str, str] = {
    "op3_quality_rules": quality_rules.ORACLE,
    "op9_va_search": va_search.ORACLE,
    "op13_phrase_mining": phrase_mining.ORACLE,
}
