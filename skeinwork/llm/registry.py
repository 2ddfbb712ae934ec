"""The operators' queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import contract
from .benchmark_leaks import op10_benchmark_leaks
from .byte_convnet import op2_byte_convnet
from .chat_templates import op4_chat_templates
from .host_extract import op5_host_extract
from .license_scan import op8_license_scan
from .mix_sources import op9_mix_sources
from .pattern_pii import op7_pattern_pii
from .ring_shards import op3_ring_shards
from .simhash_groups import op6_simhash_groups
from .span_prints import op1_span_prints


def queries() -> dict:
    """One query an operator, then those over parts of them that SQL can say."""
    return {f.__name__: f for f in (op1_span_prints, op2_byte_convnet, op3_ring_shards, op4_chat_templates, op5_host_extract, op6_simhash_groups, op7_pattern_pii, op8_license_scan, op9_mix_sources, op10_benchmark_leaks)} | contract.QUERIES


def oracle_sql() -> dict:
    return dict(contract.SQL)
