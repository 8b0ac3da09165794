"""Column expressions used by the operators (all JVM-side built-ins)."""

from spreadkit.functions.keys import bucket, partition_number, salt, seeded_rank
from spreadkit.functions.text import tokens, word_length
from spreadkit.functions.vectors import coordinates, sqdist

__all__ = [
    "bucket",
    "coordinates",
    "partition_number",
    "salt",
    "seeded_rank",
    "sqdist",
    "tokens",
    "word_length",
]
