"""Writers of event tables and results."""

from aislewise.sinks.csv_sink import write_events_csv
from aislewise.sinks.parquet_sink import pack_types, preview, write_result, write_validated

__all__ = ["pack_types", "preview", "write_events_csv", "write_result", "write_validated"]
