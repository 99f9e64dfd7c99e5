"""Queries of the package, by name, and the DuckDB SQL of those that have one."""

from __future__ import annotations

from cohortline.llm.crosstoken import op13_crosstoken_align
from cohortline.llm.ctw import op2_ctw_score
from cohortline.llm.decontaminate import op3_pigeonhole_decontaminate
from cohortline.llm.divergence import OP11_SQL, op11_segment_tree_audit
from cohortline.llm.embeddings import op6_hyperplane_neardup
from cohortline.llm.html_extract import op10_mincut_extract
from cohortline.llm.minhash import op12_minhash_fingerprints
from cohortline.llm.mixing import OP8_SQL, op8_pfair_mix
from cohortline.llm.quality import op9_cotrain_quality
from cohortline.llm.repeats import op1_runlength_repeats
from cohortline.llm.simhash import op7_simhash
from cohortline.llm.tokenfiles import op4_bitplane_tokens
from cohortline.llm.toxicity import op5_mil_toxicity

QUERIES = {
    "op1_runlength_repeats": op1_runlength_repeats,
    "op2_ctw_score": op2_ctw_score,
    "op3_pigeonhole_decontaminate": op3_pigeonhole_decontaminate,
    "op4_bitplane_tokens": op4_bitplane_tokens,
    "op5_mil_toxicity": op5_mil_toxicity,
    "op6_hyperplane_neardup": op6_hyperplane_neardup,
    "op7_simhash": op7_simhash,
    "op8_pfair_mix": op8_pfair_mix,
    "op9_cotrain_quality": op9_cotrain_quality,
    "op10_mincut_extract": op10_mincut_extract,
    "op11_segment_tree_audit": op11_segment_tree_audit,
    "op12_minhash_fingerprints": op12_minhash_fingerprints,
    "op13_crosstoken_align": op13_crosstoken_align,
}

ORACLE_SQL: dict[str, str] = {
    "op8_pfair_mix": OP8_SQL,
    "op11_segment_tree_audit": OP11_SQL,
}
