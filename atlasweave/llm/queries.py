"""The queries of this folder: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from .classifier import op1_quality_classifier
from .decontaminate import op4_benchmark_decontamination
from .html import op6_template_extraction
from .licenses import op8_license_scan
from .lm import op7_ppm_scoring
from .mixing import OP5_SQL, op5_weighted_fair_mixing
from .neardup import op3_minhash_near_dedup
from .rules import OP9_SQL, op9_quality_rules
from .sharding import op10_balanced_sharding
from .urls import OP2_SQL, op2_url_filters

QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_url_filters": op2_url_filters,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_weighted_fair_mixing": op5_weighted_fair_mixing,
    "op6_template_extraction": op6_template_extraction,
    "op7_ppm_scoring": op7_ppm_scoring,
    "op8_license_scan": op8_license_scan,
    "op9_quality_rules": op9_quality_rules,
    "op10_balanced_sharding": op10_balanced_sharding,
}
ORACLE_SQL: dict[str, str] = {
    "op2_url_filters": OP2_SQL,
    "op5_weighted_fair_mixing": OP5_SQL,
    "op9_quality_rules": OP9_SQL,
}
