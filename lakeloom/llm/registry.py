"""Queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import conversation_repair, decontaminate, embedding_dedup, url_filter
from .byte_bpe import op9_byte_bpe
from .conversation_repair import op11_conversation_repair
from .decontaminate import op13_benchmark_decontamination
from .embedding_dedup import op6_embedding_near_dedup
from .html_extract import op5_tag_path_ratios
from .packing import op3_cost_balanced_packing
from .pii import op4_weakly_supervised_pii
from .quality import op2_robust_quality_rules
from .secret_scan import op7_inferred_secret_formats
from .sharding import op10_fixed_slot_sharding
from .simhash import op8_simhash_near_dedup
from .url_filter import op1_url_filters
from .whitening import op12_jacobi_davidson_whitening

QUERIES = {f.__name__: f for f in (
    op1_url_filters,
    op2_robust_quality_rules,
    op3_cost_balanced_packing,
    op4_weakly_supervised_pii,
    op5_tag_path_ratios,
    op6_embedding_near_dedup,
    op7_inferred_secret_formats,
    op8_simhash_near_dedup,
    op9_byte_bpe,
    op10_fixed_slot_sharding,
    op11_conversation_repair,
    op12_jacobi_davidson_whitening,
    op13_benchmark_decontamination,
)}
ORACLES: dict[str, str] = {
    "op1_url_filters": url_filter.oracle_sql(),
    "op6_embedding_near_dedup": embedding_dedup.ORACLE_SQL,
    "op11_conversation_repair": conversation_repair.ORACLE_SQL,
    "op13_benchmark_decontamination": decontaminate.ORACLE_SQL,
}
