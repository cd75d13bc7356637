"""Sources: text lines, CSV, Parquet star schema, GeoJSON boundary and the events-derived fixtures."""

from .boundary import Boundary, boundary_from_text, read_boundary
from .readers import (
    STAR_TABLES, combine_csv, csv_fields, infer_schema, load_star, read_inferred_csv, read_numbered_lines, read_raw_lines, read_tolerant_csv,
    read_trips_csv,
)

__all__ = [
    "Boundary", "boundary_from_text", "read_boundary", "STAR_TABLES", "combine_csv", "csv_fields", "infer_schema", "load_star",
    "read_inferred_csv", "read_numbered_lines", "read_raw_lines", "read_tolerant_csv", "read_trips_csv",
]
