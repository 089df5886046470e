"""Small vector algebra on ``array<double>`` columns.

A series is one row, so fitting a per-series model is a projection: no shuffle,
no Python worker. ``let`` binds an intermediate value once; a column that is
merely aliased may be inlined into a lambda body and evaluated for every element.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def grid(rows: list[tuple], names: list[str]) -> Column:
    """Constant array of structs of doubles, e.g. the parameter combinations a model tries."""
    structs = (
        "named_struct(" + ", ".join(f"'{name}', {float(v)!r}D" for name, v in zip(names, row)) + ")" for row in rows
    )
    return F.expr(f"array({', '.join(structs)})")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def at(a: Column, i: Column | int) -> Column:
    """Zero-based element, NULL when out of range."""
    return F.get(a, F.lit(i) if isinstance(i, int) else i)


def steps(n: int | Column) -> Column:
    """1..n as an array of ints (empty for n < 1)."""
    if isinstance(n, int):
        return F.sequence(F.lit(1), F.lit(n))
    return F.when(n >= 1, F.sequence(F.lit(1), F.greatest(n, F.lit(1)).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )


def tail(a: Column, k: Column | int) -> Column:
    """Last ``k`` elements (all of them when the array is shorter)."""
    k = F.lit(k) if isinstance(k, int) else k

    def cut(v: Column) -> Column:
        keep = F.least(k, F.size(v))
        return F.slice(v, F.size(v) - keep + 1, keep)

    return let(a, cut)


def head(a: Column, k: Column | int) -> Column:
    k = F.lit(k) if isinstance(k, int) else k
    return F.slice(a, F.lit(1), F.greatest(k, F.lit(0)))


def push(window: Column, value: Column, k: int) -> Column:
    """Fixed-length history: drop the oldest of ``k`` values, append the newest."""
    return F.concat(F.slice(window, 2, k - 1), F.array(value))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def mean(a: Column) -> Column:
    return let(a, lambda v: F.when(F.size(v) > 0, total(v) / F.size(v)))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, z: x * z))


def constant(value: Column, h: int) -> Column:
    """Flat forecast path; NULL when there is no value."""
    return let(value, lambda v: F.when(v.isNotNull(), F.array_repeat(v, h)))


def solve(system: Column, k: int) -> Column:
    """Solution of a k x (k+1) augmented symmetric system, NULLs where it is singular."""

    def eliminate(diagonal: Column):
        def step(m: Column, j: Column) -> Column:
            def reduce_rows(pivot_row: Column) -> Column:
                p = F.get(pivot_row, j)
                usable = F.abs(p) > F.lit(1e-10) * F.abs(F.get(diagonal, j))
                unit_row = F.transform(pivot_row, lambda v: F.when(usable, F.try_divide(v, p)))
                return let(
                    unit_row,
                    lambda unit: F.transform(
                        m,
                        lambda row, i: F.when(i == j, unit).otherwise(
                            let(F.get(row, j), lambda f: F.zip_with(row, unit, lambda a, b: a - f * b))
                        ),
                    ),
                )

            return let(F.get(m, j), reduce_rows)

        return step

    def run(m: Column) -> Column:
        diagonal = F.transform(m, lambda row, i: F.get(row, i))
        reduced = let(
            diagonal, lambda d: F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), m, eliminate(d))
        )
        return let(reduced, lambda r: F.transform(r, lambda row: F.get(row, F.lit(k))))

    return let(system, run)


def least_squares(regressors: list[Column], target: Column, alpha: float = 0.0) -> Column:
    """[intercept, slopes...] of ``target`` on ``regressors``, arrays of equal length.

    ``alpha`` is the penalty on the squared slopes.

    Columns are centred before the products are summed, which keeps the normal
    equations well conditioned.
    """
    k = len(regressors)
    if k == 0:
        return F.array(mean(target))

    def slopes(x: Column) -> Column:
        rows = [
            [dot(at(x, i), at(x, j)) + (alpha if i == j else 0.0) for j in [*range(1, k + 1), 0]] for i in range(1, k + 1)
        ]
        return solve(F.array(*[F.array(*row) for row in rows]), k)

    def fit(x: Column, mu: Column) -> Column:
        centred = F.zip_with(x, mu, lambda column, c: F.transform(column, lambda v: v - c))

        def with_intercept(b: Column) -> Column:
            explained = F.aggregate(
                F.zip_with(b, F.slice(mu, 2, k), lambda s, c: s * c), F.lit(0.0), lambda acc, v: acc + v
            )
            return F.concat(F.array(at(mu, 0) - explained), b)

        return let(let(centred, slopes), with_intercept)

    return let(
        F.array(target, *regressors),
        lambda x: let(F.transform(x, mean), lambda mu: fit(x, mu)),
    )


def best(candidates: Column) -> Column:
    """Smallest struct of an array; candidates that could not be scored are NULL elements."""
    return F.array_min(F.filter(candidates, lambda c: c.isNotNull()))
