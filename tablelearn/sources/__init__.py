"""Scans: parquet tables, CSV with fixed or inferred schema, raw text lines,
and the derived classification views built from the driver tables."""

from tablelearn.sources.tables import TABLE_NAMES, read_table
from tablelearn.sources.text import (
    INJURY_COLUMNS,
    INJURY_FEATURES,
    INJURY_LABEL,
    INJURY_SCHEMA,
    features_and_label,
    parse_hand_lines,
    parse_records,
    read_csv_header,
    read_csv_positional,
    read_csv_schema,
    records_as_lines,
    rename_positional,
)

__all__ = [
    "TABLE_NAMES",
    "read_table",
    "INJURY_COLUMNS",
    "INJURY_FEATURES",
    "INJURY_LABEL",
    "INJURY_SCHEMA",
    "features_and_label",
    "parse_hand_lines",
    "parse_records",
    "read_csv_header",
    "read_csv_positional",
    "read_csv_schema",
    "records_as_lines",
    "rename_positional",
]
