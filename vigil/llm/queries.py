"""Registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from . import (decision_list, divergence, exact_topk, filter_audit, jaccard, langid, lattice, learned_index,
               mixing, sharding, token_files, warc, weaklabel)

QUERIES = {
    "op1_mixing": mixing.query,
    "op2_jaccard_join": jaccard.query,
    "op3_token_files": token_files.query,
    "op4_sentencepiece": lattice.query,
    "op5_weak_labels": weaklabel.query,
    "op6_language_id": langid.query,
    "op7_warc": warc.query,
    "op8_learned_index": learned_index.query,
    "op9_sharding": sharding.query,
    "op10_decision_list": decision_list.query,
    "op11_filter_audit": filter_audit.query,
    "op12_source_divergence": divergence.query,
    "op13_exact_topk": exact_topk.query,
}

#: Only what SQL can express has an entry.
ORACLE: dict[str, str] = {
    "op11_filter_audit": filter_audit.ORACLE_SQL,
    "op12_source_divergence": divergence.ORACLE_SQL,
    "op13_exact_topk": exact_topk.ORACLE_SQL,
}
