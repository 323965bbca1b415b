"""Operators: DataFrame in, lazy DataFrame out."""

from aislewise.operators.behaviour import conversion_funnel, hourly_activity
from aislewise.operators.quality import (
    SchemaMismatch,
    clean_events,
    cleaning_rules,
    compare_schema,
    null_counts,
    quality_measures,
    quality_report,
    require_rows,
    schema_report,
    verify_input,
)
from aislewise.operators.ranking import product_rank, rank_products
from aislewise.operators.reports import (
    funnel_by_rate,
    funnel_steps,
    hourly_histogram,
    top_rows,
)
from aislewise.operators.sales import (
    product_sales,
    revenue_by_category,
    sales_by,
    top_brands,
)
from aislewise.operators.sessions import (
    merge_session_partials,
    session_partials,
    session_sample,
    session_stats,
    session_summary,
)

__all__ = [
    "SchemaMismatch",
    "clean_events",
    "cleaning_rules",
    "compare_schema",
    "conversion_funnel",
    "funnel_by_rate",
    "funnel_steps",
    "hourly_activity",
    "hourly_histogram",
    "merge_session_partials",
    "null_counts",
    "product_rank",
    "product_sales",
    "quality_measures",
    "quality_report",
    "rank_products",
    "require_rows",
    "revenue_by_category",
    "sales_by",
    "schema_report",
    "session_partials",
    "session_sample",
    "session_stats",
    "session_summary",
    "top_brands",
    "top_rows",
    "verify_input",
]
