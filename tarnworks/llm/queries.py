"""The operators' registered queries, each over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from tarnworks.llm import (
    balltree,
    divergence,
    flat_graph,
    jump_shards,
    language,
    mixing,
    ngram_trie,
    packing,
    quality,
    simhash,
    token_store,
    whitening,
    zip_warc,
)

LLM_QUERIES = {
    "op1_rake_mixing": mixing.query,
    "op2_jump_shards": jump_shards.query,
    "op3_subword_quality": quality.query,
    "op4_ball_tree_topk": balltree.query,
    "op5_token_store": token_store.query,
    "op6_best_fit_packing": packing.query,
    "op7_language_id": language.query,
    "op8_simhash_ball": simhash.query,
    "op9_flat_graph_dedup": flat_graph.query,
    "op10_ngram_trie": ngram_trie.query,
    "op11_dominance_skyband": divergence.query,
    "op12_multiplicity_whitening": whitening.query,
    "op13_zip_warc": zip_warc.query,
}
LLM_ORACLES: dict[str, str] = {
    "op4_ball_tree_topk": balltree.ORACLE,
    "op11_dominance_skyband": divergence.ORACLE,
    "op13_zip_warc": zip_warc.ORACLE,
}
