"""Queries of the subpackage, and the SQL of those that SQL can express."""

from riboscan.llm.decontaminate import op8_latent_decontamination
from riboscan.llm.divergence import OP5_SQL, op5_distribution_divergence
from riboscan.llm.licenses import op9_license_positions
from riboscan.llm.near_dedup import OP6_SQL, op6_minhash_components
from riboscan.llm.packing import op2_length_buckets
from riboscan.llm.pseudonyms import op10_feistel_pseudonyms
from riboscan.llm.quality import op3_rule_ensemble
from riboscan.llm.secrets import op4_secret_automaton
from riboscan.llm.urls import OP7_SQL, op7_bloom_url_filter
from riboscan.llm.warc import OP1_SQL, op1_warc_index_merge

QUERIES = {
    "op1_warc_index_merge": op1_warc_index_merge,
    "op2_length_buckets": op2_length_buckets,
    "op3_rule_ensemble": op3_rule_ensemble,
    "op4_secret_automaton": op4_secret_automaton,
    "op5_distribution_divergence": op5_distribution_divergence,
    "op6_minhash_components": op6_minhash_components,
    "op7_bloom_url_filter": op7_bloom_url_filter,
    "op8_latent_decontamination": op8_latent_decontamination,
    "op9_license_positions": op9_license_positions,
    "op10_feistel_pseudonyms": op10_feistel_pseudonyms,
}

SQL = {
    "op1_warc_index_merge": OP1_SQL,
    "op5_distribution_divergence": OP5_SQL,
    "op6_minhash_components": OP6_SQL,
    "op7_bloom_url_filter": OP7_SQL,
}
