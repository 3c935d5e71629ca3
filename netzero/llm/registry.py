"""Registered queries of this subpackage and their DuckDB SQL, where SQL can say it."""

from __future__ import annotations

from . import (op1_pii, op2_exact_dedup, op3_secrets, op4_toxicity, op5_suffix, op6_mixing, op7_decontaminate, op8_warc,
               op9_simhash, op10_chunks, op11_centroids, op12_lexical, op13_topk)

QUERIES = {
    "op1_pii": op1_pii.op1_pii,
    "op2_exact_dedup": op2_exact_dedup.op2_exact_dedup,
    "op3_secrets": op3_secrets.op3_secrets,
    "op4_toxicity": op4_toxicity.op4_toxicity,
    "op5_suffix": op5_suffix.op5_suffix,
    "op6_mixing": op6_mixing.op6_mixing,
    "op7_decontaminate": op7_decontaminate.op7_decontaminate,
    "op8_warc": op8_warc.op8_warc,
    "op9_simhash": op9_simhash.op9_simhash,
    "op10_chunks": op10_chunks.op10_chunks,
    "op11_centroids": op11_centroids.op11_centroids,
    "op12_lexical": op12_lexical.op12_lexical,
    "op13_topk": op13_topk.op13_topk,
}

SQL = {
    "op2_exact_dedup": op2_exact_dedup.ORACLE,
    "op8_warc": op8_warc.ORACLE,
    "op11_centroids": op11_centroids.ORACLE,
    "op12_lexical": op12_lexical.ORACLE,
    "op13_topk": op13_topk.ORACLE,
}
