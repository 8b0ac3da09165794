"""A streaming text-line source.

The reference reads bounded files only, so there is no streaming operator. The
parsers and count operators are plain DataFrame transformations and take the
lines of this source as they are, as incremental aggregations.
"""

from spreadkit.streaming.text import read_lines_stream

__all__ = ["read_lines_stream"]
