"""Readers and the synthetic event generator."""

from aislewise.sources.csv_events import (
    discover_inputs,
    read_header,
    sample_csv,
    scan_csv,
    scan_rejects,
)
from aislewise.sources.parquet_events import load_events, load_rejects
from aislewise.sources.synthetic import generate_events, write_synthetic_csv

__all__ = [
    "discover_inputs",
    "generate_events",
    "load_events",
    "load_rejects",
    "read_header",
    "sample_csv",
    "scan_csv",
    "scan_rejects",
    "write_synthetic_csv",
]
