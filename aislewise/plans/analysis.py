"""All analyses over validated events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aislewise.operators import (
    conversion_funnel,
    hourly_activity,
    merge_session_partials,
    product_sales,
    rank_products,
    require_rows,
    revenue_by_category,
    session_partials,
    session_sample,
    session_summary,
    top_brands,
)
from aislewise.sinks import write_result
from aislewise.sources import load_events

Build = Callable[[DataFrame], DataFrame]

# Results computed from the events, one job each. Every job scans the stored
# events again: the scan is cut down to its columns and event types, which is
# cheaper than keeping all of them cached.
FROM_EVENTS: dict[str, Build] = {
    "revenue_by_category": revenue_by_category,
    "conversion_funnel": conversion_funnel,
    "hourly_activity": hourly_activity,
    "session_partials": session_partials,
    "top_brands": top_brands,
    "product_sales": product_sales,
}
# Results computed from another result. The partials stay, to be merged with those of later months.
FROM_RESULT: dict[str, tuple[str, Build]] = {
    "product_rank": ("product_sales", rank_products),
    "session_stats": ("session_partials", merge_session_partials),
    "session_summary": ("session_stats", session_summary),
    "session_sample": ("session_stats", session_sample),
}


def analyse(spark: SparkSession, validated: str, output: str) -> dict[str, str]:
    """Write every result below output and return the paths by name."""
    events = load_events(spark, validated)
    require_rows(events)
    paths = {name: f"{output}/{name}" for name in (*FROM_EVENTS, *FROM_RESULT)}
    for name, build in FROM_EVENTS.items():
        write_result(build(events), paths[name])
    for name, (source, build) in FROM_RESULT.items():
        write_result(build(spark.read.parquet(paths[source])), paths[name])
    return paths
