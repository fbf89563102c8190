"""The registered query of each corpus operator, and SQL where SQL can say
the same over whole tables."""

from hazrank.llm import exact_dedup, fingerprints, lexical, merkle, mixing, packing, pii, quality, simhash, suffix_dedup, token_files, toxicity, url_rules

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_pack": packing.op3_pack,
    "op4_simhash": simhash.op4_simhash,
    "op5_url_rules": url_rules.op5_url_rules,
    "op6_pii": pii.op6_pii,
    "op7_fingerprints": fingerprints.op7_fingerprints,
    "op8_token_files": token_files.op8_token_files,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_search": lexical.op11_search,
    "op12_merkle": merkle.op12_merkle,
    "op13_quality": quality.op13_quality,
}

ORACLE_SQL = {
    "op1_mix_sources": mixing.ORACLE_SQL,
    "op2_exact_dedup": exact_dedup.ORACLE_SQL,
    "op11_search": lexical.ORACLE_SQL,
    "op12_merkle": merkle.ORACLE_SQL,
}
