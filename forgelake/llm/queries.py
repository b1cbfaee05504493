"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from forgelake.llm import (
    filter_audit,
    fingerprints,
    jaccard,
    langid,
    mixing,
    neardup,
    packing,
    periodic_runs,
    pieces,
    quality,
    repeats,
    secret_scan,
    toxicity,
)

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_secret_scan": secret_scan.op2_secret_scan,
    "op3_language_id": langid.op3_language_id,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_repeated_spans": repeats.op5_repeated_spans,
    "op6_embedding_neardup": neardup.op6_embedding_neardup,
    "op7_jaccard_join": jaccard.op7_jaccard_join,
    "op8_quality": quality.op8_quality,
    "op9_mixing_schedule": mixing.op9_mixing_schedule,
    "op10_fingerprints": fingerprints.op10_fingerprints,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_piece_encoding": pieces.op12_piece_encoding,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

ORACLE_SQL = {
    "op6_embedding_neardup": neardup.ORACLE_SQL,
    "op7_jaccard_join": jaccard.ORACLE_SQL,
    "op2_secret_scan": secret_scan.ORACLE_SQL,
    "op9_mixing_schedule": mixing.ORACLE_SQL,
    "op11_filter_audit": filter_audit.ORACLE_SQL,
}
