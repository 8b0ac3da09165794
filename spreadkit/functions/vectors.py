"""Vector expressions over ``array<double>`` columns.

When the dimension is known (operators check it once per point set) the
squared distance is written out term by term: plain arithmetic on array items
stays inside whole-stage codegen, while the higher-order form below is
evaluated row by row. Both add left to right starting from 0, so they agree
bit for bit with each other and with an oracle that writes the same sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to this dimension the squared distance is written out term by term (one
# SQL string, compiled into the whole-stage code); measured on 64-D points it
# runs 3-4 times faster than the higher-order form. Beyond it the generated
# code grows too large and the higher-order form is used.
MAX_UNROLLED_DIM = 128


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _double(x: float) -> str:
    """An exact Spark SQL double literal (shortest round-trip text)."""
    x = float(x)
    if x != x or x in (float("inf"), float("-inf")):
        raise ValueError("coordinates must be finite")
    return f"({x!r}D)".replace("e", "E")


def sqdist_sql(a: str, b: str | list[float], dim: int | None) -> str:
    """SQL text of the squared distance of a named array column to another
    named array column or to a fixed point.

    Unrolled term by term up to ``MAX_UNROLLED_DIM``; otherwise the
    higher-order ``aggregate(zip_with(...))`` form, which also adds left to
    right from 0.
    """
    qa = _quoted(a)
    if dim is not None and 0 < dim <= MAX_UNROLLED_DIM:
        if isinstance(b, str):
            qb = _quoted(b)
            other = [f"{qb}[{i}]" for i in range(dim)]
        else:
            other = [_double(x) for x in b]
        terms = [f"({qa}[{i}] - {o}) * ({qa}[{i}] - {o})" for i, o in enumerate(other)]
        return "(" + " + ".join(terms) + ")"
    qb = _quoted(b) if isinstance(b, str) else "array(" + ", ".join(_double(x) for x in b) + ")"
    return f"aggregate(zip_with({qa}, {qb}, (x, y) -> (x - y) * (x - y)), 0D, (acc, t) -> acc + t)"


def sqdist(a: Column | str, b: Column | str | list[float], dim: int | None = None) -> Column:
    """Squared Euclidean distance of two equal-length double arrays.

    ``b`` may also be a fixed point (a list of floats). With column names the
    expression is handed to Spark as one SQL string, which plans in a single
    call instead of one call per expression node.
    """
    if dim == 0:
        return F.lit(0.0)
    if isinstance(b, list) and dim is not None and len(b) != dim:
        raise ValueError("a fixed point needs the dimension of the set")
    if isinstance(a, str) and isinstance(b, (str, list)):
        return F.expr(sqdist_sql(a, b, dim))
    if isinstance(b, list):
        b = F.array(*[F.lit(float(x)) for x in b])
    a, b = _col(a), _col(b)
    if dim is not None and 0 < dim <= MAX_UNROLLED_DIM:
        total = None
        for i in range(dim):
            diff = a.getItem(i) - b.getItem(i)
            term = diff * diff
            total = term if total is None else total + term
        return total
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)),
        F.lit(0.0).cast("double"),
        lambda acc, v: acc + v,
    )


def coordinates(vec: Column | str, dim: int, prefix: str = "x") -> list[Column]:
    """One column per coordinate, named ``x0 .. x{dim-1}``."""
    vec = _col(vec)
    return [vec.getItem(i).alias(f"{prefix}{i}") for i in range(dim)]
