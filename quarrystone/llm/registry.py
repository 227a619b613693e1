"""Queries and SQL of this subpackage."""

from __future__ import annotations

import corpus_pipeline
from quarrystone.llm import crosstok, decontam, exactdup, licenses, lmscore, mixing, neardup, quality, sharding, suffixdup, urls, warc, whitening

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_quality": quality.op1_quality,
    "op2_suffixes": suffixdup.op2_suffixes,
    "op3_url_filter": urls.op3_url_filter,
    "op4_decontaminate": decontam.op4_decontaminate,
    "op5_minhash": neardup.op5_minhash,
    "op6_warc": warc.op6_warc,
    "op7_interleave": sharding.op7_interleave,
    "op8_pseudo_likelihood": lmscore.op8_pseudo_likelihood,
    "op9_licenses": licenses.op9_licenses,
    "op10_mix": mixing.op10_mix,
    "op11_token_alignment": crosstok.op11_token_alignment,
    "op12_exact_dedup": exactdup.op12_exact_dedup,
    "op13_whitening": whitening.op13_whitening,
}

ORACLES = {
    "pipeline": corpus_pipeline.ORACLE_SQL,
    "op1_quality": quality.OP1_SQL,
    "op4_decontaminate": decontam.OP4_SQL,
    "op5_minhash": neardup.OP5_SQL,
    "op7_interleave": sharding.OP7_SQL,
    "op9_licenses": licenses.OP9_SQL,
    "op10_mix": mixing.OP10_SQL,
    "op12_exact_dedup": exactdup.OP12_SQL,
}
