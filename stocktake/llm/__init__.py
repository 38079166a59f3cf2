"""Operators of a training-data pipeline. Nothing else in the library imports this package.

QUERIES and ORACLES map query names to callables of (session, folder) and to DuckDB SQL.
"""

from . import (
    op1_pii,
    op2_packing,
    op3_token_counts,
    op4_decontamination,
    op5_quality_rules,
    op6_line_dedup,
    op7_sharding,
    op8_substring_dedup,
    op9_jaccard_join,
    op10_license_scans,
    op11_simhash,
    op12_conversation_repair,
    op13_centroid_clustering,
)

_MODULES = (
    op1_pii,
    op2_packing,
    op3_token_counts,
    op4_decontamination,
    op5_quality_rules,
    op6_line_dedup,
    op7_sharding,
    op8_substring_dedup,
    op9_jaccard_join,
    op10_license_scans,
    op11_simhash,
    op12_conversation_repair,
    op13_centroid_clustering,
)
_NAMES = [m.__name__.rsplit(".", 1)[1] for m in _MODULES]

QUERIES = {name: getattr(m, name) for name, m in zip(_NAMES, _MODULES, strict=True)}
ORACLES = {name: m.SQL for name, m in zip(_NAMES, _MODULES, strict=True) if m.SQL}
