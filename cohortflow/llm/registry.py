"""The operators' queries over the driver tables, and their DuckDB counterparts where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from cohortflow.llm import align, ann, dedup, jaccard, mixing, packing, phrases, pii, quality, sharding, simhash, toxicity, urls

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_quality": quality.op2_quality,
    "op3_packing": packing.op3_packing,
    "op4_ngram_jaccard": jaccard.op4_ngram_jaccard,
    "op5_exact_dedup": dedup.op5_exact_dedup,
    "op6_pii": pii.op6_pii,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_nn_descent": ann.op8_nn_descent,
    "op9_hilbert_sharding": sharding.op9_hilbert_sharding,
    "op10_url_filters": urls.op10_url_filters,
    "op11_simhash": simhash.op11_simhash,
    "op12_collocations": phrases.op12_collocations,
    "op13_alignment": align.op13_alignment,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_mixing": mixing.OP1_SQL,
    "op4_ngram_jaccard": jaccard.OP4_SQL,
    "op5_exact_dedup": dedup.OP5_SQL,
    "op10_url_filters": urls.OP10_SQL,
    "op12_collocations": phrases.OP12_SQL,
}
