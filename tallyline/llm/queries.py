"""The registered query of each operator, and its SQL where SQL can express it."""

from tallyline.llm import (bottom_k, bpe, embed_dedup, hard_negatives, line_dedup, mixing, quality, sharding, simhash_dedup, spelling,
                           suffix_dedup, token_files, warc)

QUERIES = {
    "op1_embedding_dedup": embed_dedup.query,
    "op2_drop_repeated_lines": line_dedup.query,
    "op3_byte_bpe": bpe.query,
    "op4_mix_sources": mixing.query,
    "op5_token_files": token_files.query,
    "op6_shard_rows": sharding.query,
    "op7_remove_repeats": suffix_dedup.query,
    "op8_simhash_dedup": simhash_dedup.query,
    "op9_quality_rules": quality.query,
    "op10_warc": warc.query,
    "op11_spelling_variants": spelling.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_document_fingerprints": bottom_k.query,
}
ORACLE = {
    "op2_drop_repeated_lines": line_dedup.SQL,
    "op4_mix_sources": mixing.SQL,
    "op10_warc": warc.SQL,
    "op11_spelling_variants": spelling.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
}
