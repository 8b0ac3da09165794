"""Sources: text lines, labelled pairs, points, and the test-table projections."""

from spreadkit.sources.labelled import parse_labelled
from spreadkit.sources.points import VECTOR, parse_points, points_from_columns
from spreadkit.sources.text import numbered_lines, read_lines

__all__ = ["VECTOR", "numbered_lines", "parse_labelled", "parse_points", "points_from_columns", "read_lines"]
