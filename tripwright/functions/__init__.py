"""Column functions: timestamp parsing and formatting, trip distance and duration, boundary test."""

from .geo import haversine_km, within_boundary, register_functions
from .timefmt import duration_s, format_ts, parse_ts, shape_regex

__all__ = ["haversine_km", "within_boundary", "register_functions", "duration_s", "format_ts", "parse_ts", "shape_regex"]
