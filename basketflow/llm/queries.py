"""Name -> (query, SQL or None) of the operators in this subpackage."""

from basketflow.llm import bpe, chat, decontaminate, hard_negatives, licenses, mixing, prefix_trie, quality, records, sharding, simhash, suffix_dedup, toxicity

REGISTRY = {
    "op1_token_records": (records.op1_token_records, None),
    "op2_decontaminate": (decontaminate.op2_decontaminate, None),
    "op3_toxicity": (toxicity.op3_toxicity, None),
    "op4_mix": (mixing.op4_mix, mixing.OP4_SQL),
    "op5_licenses": (licenses.op5_licenses, None),
    "op6_shards": (sharding.op6_shards, None),
    "op7_quality": (quality.op7_quality, None),
    "op8_suffix_dedup": (suffix_dedup.op8_suffix_dedup, None),
    "op9_tool_calls": (chat.op9_tool_calls, chat.OP9_SQL),
    "op10_simhash": (simhash.op10_simhash, None),
    "op11_hard_negatives": (hard_negatives.op11_hard_negatives, hard_negatives.OP11_SQL),
    "op12_prefix_trie": (prefix_trie.op12_prefix_trie, None),
    "op13_byte_bpe": (bpe.op13_byte_bpe, None),
}
