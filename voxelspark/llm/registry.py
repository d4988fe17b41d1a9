"""The corpus queries by name, and SQL for those that SQL can express."""

import corpus_pipeline
from voxelspark.llm import decontaminate, divergence, htmltext, licenses, linededup, lmscore, mixing, neardup, prefixtrie, sharding, tokencount, topk, toxicity

QUERIES = {
    "op1_lm_score": lmscore.op1_lm_score,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_line_dedup": linededup.op3_line_dedup,
    "op4_token_counts": tokencount.op4_token_counts,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_mix_sources": mixing.op6_mix_sources,
    "op7_top_k": topk.op7_top_k,
    "op8_near_duplicates": neardup.op8_near_duplicates,
    "op9_shards": sharding.op9_shards,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_html_text": htmltext.op11_html_text,
    "op12_prefix_trie": prefixtrie.op12_prefix_trie,
    "op13_source_divergence": divergence.op13_source_divergence,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op2_license_scan": licenses.ORACLE,
    "op3_line_dedup": linededup.ORACLE,
    "op6_mix_sources": mixing.ORACLE,
    "op7_top_k": topk.ORACLE,
    "op8_near_duplicates": neardup.ORACLE,
    "op9_shards": sharding.ORACLE,
    "op12_prefix_trie": prefixtrie.oracle(sharding._crc_table()),
    "op13_source_divergence": divergence.ORACLE,
}
