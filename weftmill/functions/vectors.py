"""Vector algebra on `array<double>` columns with built-in functions only (no shuffle, no Python)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the tanh form of GELU and of the softmax underflow guard.
GELU_SCALE = 0.797884560802
GELU_CUBIC = 0.044715
EXP_UNDERFLOW = -745.13
MASK_ADDEND = -1e10
NORM_EPSILON = 1e-5


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it by name inside `body` (also inside nested lambdas)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _paired(value: Column) -> Column:
    """`value` of a pair of elements; one that is missing on either side fails the job."""
    return F.coalesce(value, F.raise_error(F.lit("vectors differ in width or have a null element")))


def vec_add(a: Column | str, b: Column | str) -> Column:
    """Element-wise sum. A null vector gives null; other widths or a null element fail the job."""
    if isinstance(a, str) and isinstance(b, str):
        return F.expr(f"zip_with(`{a}`, `{b}`, (x, y) -> coalesce(x + y, {_WRONG}))")
    return F.zip_with(_col(a), _col(b), lambda x, y: _paired(x + y))


def vec_mul(a: Column | str, b: Column | str) -> Column:
    """Element-wise product. A null vector gives null; other widths or a null element fail the job."""
    return F.zip_with(_col(a), _col(b), lambda x, y: _paired(x * y))


def vec_scale(a: Column | str, factor: Column | float) -> Column:
    """Every element times one number."""
    s = factor if isinstance(factor, Column) else F.lit(float(factor))
    return F.transform(_col(a), lambda x: x * s)


def inner_product(a: Column | str, b: Column | str) -> Column:
    """Sum of element-wise products, as double."""
    return F.aggregate(vec_mul(a, b), F.lit(0.0), lambda acc, x: acc + x)


def vec_slice(v: Column | str, start: Column | int, length: Column | int) -> Column:
    """`length` elements from the 1-based position `start`."""
    return F.slice(_col(v), start, length)


def vec_preview(v: Column | str, n: int = 5) -> Column:
    """The first `n` elements."""
    return F.slice(_col(v), 1, n)


_WRONG = "raise_error('vectors differ in width or have a null element')"


def normalise(v: str, gain: str, bias: str, eps: float = NORM_EPSILON) -> Column:
    """`(v - mean) / sqrt(population variance + eps) * gain + bias` of three columns by name.

    One SQL expression: nested lambdas are slow to build one by one.
    """
    once = lambda value, name, body: f"get(transform(array({value}), {name} -> {body}), 0)"
    scaled = f"zip_with(transform(c, x -> x / s), `{gain}`, (x, y) -> coalesce(x * y, {_WRONG}))"
    moved = f"zip_with({scaled}, `{bias}`, (x, y) -> coalesce(x + y, {_WRONG}))"
    spread = f"sqrt(aggregate(c, 0D, (a, x) -> a + x * x) / size(c) + {eps!r}D)"
    centred = once(f"transform(`{v}`, x -> x - m)", "c", once(spread, "s", moved))
    return F.expr(once(f"aggregate(`{v}`, 0D, (a, x) -> a + x) / size(`{v}`)", "m", centred))


def gelu(v: Column | str) -> Column:
    """tanh form of GELU on every element."""
    if isinstance(v, str):
        return F.expr(f"transform(`{v}`, x -> 0.5D * x * (1D + tanh({GELU_SCALE}D * (x + {GELU_CUBIC}D * x * x * x))))")
    return F.transform(
        v,
        lambda x: F.lit(0.5)
        * x
        * (F.lit(1.0) + F.tanh(F.lit(GELU_SCALE) * (x + F.lit(GELU_CUBIC) * x * x * x))),
    )


def safe_exp(diff: Column) -> Column:
    """`exp`, with 0 below the smallest argument that still gives a positive double."""
    return F.when(diff < F.lit(EXP_UNDERFLOW), F.lit(0.0)).otherwise(F.exp(diff))
