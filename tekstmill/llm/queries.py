"""The registered queries of this subpackage, and their SQL twins where SQL can express them."""

from __future__ import annotations

from . import (
    bpe, edit_prints, fim, forest, mixing, nn_descent, quality, runs, token_files, toxicity, url_filter, warc, wrapper,
)

QUERIES = {
    "op1_warc_merge": warc.op1_warc_merge,
    "op2_wrapper_text": wrapper.op2_wrapper_text,
    "op3_ngram_forest": forest.op3_ngram_forest,
    "op4_mix_sources": mixing.op4_mix_sources,
    "op5_token_files": token_files.op5_token_files,
    "op6_bpe_round_trip": bpe.op6_bpe_round_trip,
    "op7_nn_descent": nn_descent.op7_nn_descent,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_edit_prints": edit_prints.op9_edit_prints,
    "op10_quality": quality.op10_quality,
    "op11_fill_in_middle": fim.op11_fill_in_middle,
    "op12_periodic_runs": runs.op12_periodic_runs,
    "op13_url_filter": url_filter.op13_url_filter,
}

ORACLES = {"op1_warc_merge": warc.OP1_SQL, "op4_mix_sources": mixing.OP4_SQL, "op11_fill_in_middle": fim.OP11_SQL}
