"""The registered queries of the operators and the SQL they must agree with."""

from __future__ import annotations

import corpus_pipeline
from trackspark.llm import bpe, jaccard, langid, mixing, packing, pii, quality, substrings, tokens, topk, variants, vectorcodes, warc

QUERIES = {
    "op1_jaccard": jaccard.op1_jaccard,
    "op2_quality": quality.op2_quality,
    "op3_packing": packing.op3_packing,
    "op4_pii": pii.op4_pii,
    "op5_substrings": substrings.op5_substrings,
    "op6_mixing": mixing.op6_mixing,
    "op7_langid": langid.op7_langid,
    "op8_tokens": tokens.op8_tokens,
    "op9_warc": warc.op9_warc,
    "op10_topk": topk.op10_topk,
    "op11_bpe": bpe.op11_bpe,
    "op12_vectorcodes": vectorcodes.op12_vectorcodes,
    "op13_variants": variants.op13_variants,
    "pipeline": corpus_pipeline.run,
}
SQL = {
    "op1_jaccard": jaccard.OP1_SQL,
    "op5_substrings": substrings.OP5_SQL,
    "op6_mixing": mixing.OP6_SQL,
    "op9_warc": warc.OP9_SQL,
    "op10_topk": topk.OP10_SQL,
    "op12_vectorcodes": vectorcodes.OP12_SQL,
    "op13_variants": variants.OP13_SQL,
}
