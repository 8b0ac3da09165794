"""spreadkit: counting and far-apart point selection as Spark DataFrame operators."""

__version__ = "0.1.0"
