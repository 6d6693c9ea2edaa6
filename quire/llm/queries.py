"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from quire.llm import sql
from quire.llm.bpe import op4_bpe_merge_rounds
from quire.llm.decontaminate import op8_cgk_decontamination
from quire.llm.langid import op6_word_first_langid
from quire.llm.negatives import op13_four_russians_negatives
from quire.llm.packing import op12_bounded_best_fit
from quire.llm.quality import op2_factorisation_quality
from quire.llm.repair import op11_cyk_repair
from quire.llm.setsketch import op9_setsketch_groups
from quire.llm.substrings import op7_rabin_karp_windows
from quire.llm.suffixes import op5_deep_shallow_dedup
from quire.llm.tokencount import op3_transducer_counts
from quire.llm.topk import op10_threshold_topk
from quire.llm.urls import op1_url_redirects

QUERIES = {f.__name__: f for f in (
    op1_url_redirects,
    op2_factorisation_quality,
    op3_transducer_counts,
    op4_bpe_merge_rounds,
    op5_deep_shallow_dedup,
    op6_word_first_langid,
    op7_rabin_karp_windows,
    op8_cgk_decontamination,
    op9_setsketch_groups,
    op10_threshold_topk,
    op11_cyk_repair,
    op12_bounded_best_fit,
    op13_four_russians_negatives,
)}

ORACLE = {
    "op1_url_redirects": sql.OP1,
    "op7_rabin_karp_windows": sql.OP7,
    "op9_setsketch_groups": sql.OP9,
    "op10_threshold_topk": sql.OP10,
    "op11_cyk_repair": sql.OP11,
    "op13_four_russians_negatives": sql.OP13,
}
