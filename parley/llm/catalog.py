"""Queries of this folder and the SQL that checks them."""

from __future__ import annotations

from parley.llm import anchor_simhash, block_topk, cross_polytope, dartminhash, mixing, phrases, pieces, pii, prefix_free, secrets, sentence_spans, toxicity, variants

QUERIES = {
    "op1_exact_topk": block_topk.op1_exact_topk,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_near_duplicates": dartminhash.op3_near_duplicates,
    "op4_sentence_spans": sentence_spans.op4_sentence_spans,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op6_repeated_bytes": prefix_free.op6_repeated_bytes,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_nearest": cross_polytope.op9_nearest,
    "op10_personal_data": pii.op10_personal_data,
    "op11_simhash_anchors": anchor_simhash.op11_simhash_anchors,
    "op12_collocations": phrases.op12_collocations,
    "op13_spelling_variants": variants.op13_spelling_variants,
}
ORACLES = {
    "op1_exact_topk": block_topk.OP1_SQL,
    "op7_mix_sources": mixing.OP7_SQL,
    "op12_collocations": phrases.OP12_SQL,
}
