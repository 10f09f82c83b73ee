"""DataFrame -> DataFrame operators."""

from .documents import (
    add_lineage,
    coerce_numeric,
    conform,
    content_hash,
    from_ndjson,
    hash_ids,
    nulls_for_nan,
    number_copies,
    ordered_positions,
    position_ids,
    to_bulk,
    to_documents,
    to_ndjson,
)
from .indicators import clean_indicators, judge_indicators, normalize_columns, project_indicators, rate_summary
from .keys import common_keys, coverage, distinct_keys, metric_stats, sorted_preview
from .moments import merge_moments, moments, moments_corr, moments_profile
from .pages import search_page
from .quality import (
    attrition,
    drop_critical_nulls,
    figures,
    missing_columns,
    observed,
    payload_report,
    require_columns,
    require_rows,
    required_fields,
    split_rejects,
    stage_counts,
    tag_rejects,
    validate,
)
from .readings import (
    accept_status,
    clean_readings,
    daily_stats,
    extract_readings,
    filter_readings,
    judge_readings,
    merge_daily,
    normalize_readings,
)
from .rollup import combine, combine_years, year_bounds, year_window, yearly_stats
from .search import search, search_facets, search_total, terms_topk
from .stats import corr_vs_anchor, null_profile, numeric_columns, pearson, profile

__all__ = [
    "accept_status",
    "add_lineage",
    "attrition",
    "clean_indicators",
    "clean_readings",
    "coerce_numeric",
    "combine",
    "combine_years",
    "common_keys",
    "conform",
    "content_hash",
    "corr_vs_anchor",
    "coverage",
    "daily_stats",
    "distinct_keys",
    "drop_critical_nulls",
    "extract_readings",
    "figures",
    "judge_indicators",
    "judge_readings",
    "filter_readings",
    "from_ndjson",
    "hash_ids",
    "merge_daily",
    "merge_moments",
    "metric_stats",
    "missing_columns",
    "moments",
    "moments_corr",
    "moments_profile",
    "normalize_columns",
    "normalize_readings",
    "null_profile",
    "nulls_for_nan",
    "number_copies",
    "numeric_columns",
    "observed",
    "ordered_positions",
    "payload_report",
    "pearson",
    "position_ids",
    "profile",
    "project_indicators",
    "rate_summary",
    "require_columns",
    "require_rows",
    "required_fields",
    "search",
    "search_facets",
    "search_page",
    "search_total",
    "sorted_preview",
    "split_rejects",
    "stage_counts",
    "tag_rejects",
    "terms_topk",
    "to_bulk",
    "to_documents",
    "to_ndjson",
    "validate",
    "year_bounds",
    "year_window",
    "yearly_stats",
]
