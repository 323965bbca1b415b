"""Jobs composed of sources, operators and sinks."""

from aislewise.plans.analysis import analyse
from aislewise.plans.end_to_end import follow, run
from aislewise.plans.incremental import SyncOutcome, live_events, live_rejects, sync
from aislewise.plans.ingest import IngestOutcome, ingest
from aislewise.plans.rollup import (
    RollupOutcome,
    follow_sessions,
    rollup_sessions,
    rollup_summary,
    update_rollup,
)

__all__ = [
    "IngestOutcome",
    "RollupOutcome",
    "SyncOutcome",
    "analyse",
    "follow",
    "follow_sessions",
    "ingest",
    "live_events",
    "live_rejects",
    "rollup_sessions",
    "rollup_summary",
    "run",
    "sync",
    "update_rollup",
]
