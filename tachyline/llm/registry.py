"""The queries of this subpackage, and the SQL for those that SQL can express."""

from . import chat_format, language_id, manifest, merkle, ngram_join, pieces, prefix_trie, secret_scan, string_tiling, suffix_dedup, token_store, toxicity, warc

QUERIES = {
    "op1_ngram_jaccard_join": ngram_join.op1_ngram_jaccard_join,
    "op2_string_tiling_decontamination": string_tiling.op2_string_tiling_decontamination,
    "op3_secret_scan": secret_scan.op3_secret_scan,
    "op4_merkle_fingerprints": merkle.op4_merkle_fingerprints,
    "op5_chat_formatting": chat_format.op5_chat_formatting,
    "op6_language_id": language_id.op6_language_id,
    "op7_warc_bundles": warc.op7_warc_bundles,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_toxicity_severity": toxicity.op9_toxicity_severity,
    "op10_suffix_array_dedup": suffix_dedup.op10_suffix_array_dedup,
    "op11_token_store": token_store.op11_token_store,
    "op12_merkle_manifest": manifest.op12_merkle_manifest,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}
ORACLE = {
    "op1_ngram_jaccard_join": ngram_join.SQL,
    "op4_merkle_fingerprints": merkle.SQL,
    "op5_chat_formatting": chat_format.SQL,
    "op7_warc_bundles": warc.SQL,
    "op10_suffix_array_dedup": suffix_dedup.SQL,
    "op12_merkle_manifest": manifest.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
