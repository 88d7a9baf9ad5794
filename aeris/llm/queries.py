"""Queries of this subpackage, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from aeris.llm import (
    bpe,
    embeddings,
    langid,
    minhash,
    packing,
    pii,
    prefix_trie,
    quality_gam,
    quality_rules,
    spelling,
    suffix_dedup,
    toxicity,
    warc,
)

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_minhash": minhash.op2_minhash,
    "op3_bpe": bpe.op3_bpe,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_embedding_dedup": embeddings.op5_embedding_dedup,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_language_id": langid.op7_language_id,
    "op8_warc": warc.op8_warc,
    "op9_packing": packing.op9_packing,
    "op10_quality": quality_gam.op10_quality,
    "op11_spelling": spelling.op11_spelling,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_pii": pii.op13_pii,
}

ORACLE_SQL = {
    "op1_quality_rules": quality_rules.ORACLE_SQL,
    "op8_warc": warc.ORACLE_SQL,
    "op11_spelling": spelling.ORACLE_SQL,
    "op12_prefix_trie": prefix_trie.ORACLE_SQL,
}
