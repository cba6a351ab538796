"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline
from telcolens.llm import bitplanes, collocations, cotraining, harmonic_packing, host_reputation, mil_toxicity, pivotal_mix, prefix_forest, signature_tree, spaced_seeds, spelling_fm, suffix_tree_lm, warc_index

QUERIES = {
    "op1_suffix_tree_lm": suffix_tree_lm.query,
    "op2_spaced_seeds": spaced_seeds.query,
    "op3_prefix_forest": prefix_forest.query,
    "op4_signature_tree": signature_tree.query,
    "op5_warc_index": warc_index.query,
    "op6_mil_toxicity": mil_toxicity.query,
    "op7_cotraining": cotraining.query,
    "op8_host_reputation": host_reputation.query,
    "op9_pivotal_mix": pivotal_mix.query,
    "op10_bitplanes": bitplanes.query,
    "op11_harmonic_packing": harmonic_packing.query,
    "op12_spelling_fm": spelling_fm.query,
    "op13_collocations": collocations.query,
}


def queries() -> dict:
    return QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op2_spaced_seeds": spaced_seeds.sql(), "op5_warc_index": warc_index.sql(), "op8_host_reputation": host_reputation.sql()}
