"""Operators for preparing training text: counting, joining, filtering, packing.

Nothing else in the library imports this package; ``queries`` and ``oracles``
hold what is registered.
"""
