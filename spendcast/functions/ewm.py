"""Exponentially weighted means as plain weighted sums.

With decay ``w`` the adjusted mean at position ``i`` is
``y_i = sum_j<=i w^(i-j) x_j / D_i`` with ``D_i = (1 - w^i) / (1 - w)``.
Both the last value and the average of ``y`` over a series of ``n`` values are
linear in ``x`` with weights that depend on the position alone:

    last    = B / D_n                              B = sum_j x_j w^(n-j)
    average = (A - w T(n+1) B) / n                 A = sum_j x_j T(j)
    T(j)    = sum_i>=j w^(i-j) / D_i = 1/D_j + w T(j+1),  T(j) -> 1

so they are ordinary sums that combine map-side, with no ordered pass and no
collected array. ``T`` differs from 1 only for the first few hundred positions.
"""

from __future__ import annotations

from functools import cache

import numpy as np

# Fixed value: centre of mass 9.5, so w = 1 - 1/(1 + 9.5).
DECAY = 1.0 - 1.0 / 10.5
HEAD = 400  # w**HEAD < 1e-17: T(HEAD) is 1 in double precision


def head_weights() -> list[float]:
    weights, following = [], 1.0
    for j in range(HEAD, 0, -1):
        following = (1.0 - DECAY) / (1.0 - DECAY**j) + DECAY * following
        weights.append(following)
    return weights[::-1]


HEAD_WEIGHTS = "array({})".format(", ".join(f"{t!r}D" for t in head_weights()))
POWERS = "array({})".format(", ".join(f"{DECAY**k!r}D" for k in range(HEAD)))

# SQL text rather than Column calls: wide jobs use these many times, and one
# parsed string costs far less on the driver than a tree of Python calls.


def head_weight(position: str) -> str:
    """T(position); positions below 1 belong to null values and get any weight."""
    return f"element_at({HEAD_WEIGHTS}, int(least(greatest({position}, 1), {HEAD})))"


def tail_weight(rows_after: str) -> str:
    """w^rows_after; a table serves all weights that matter, as pow is slow."""
    return (
        f"if({rows_after} < {HEAD}, element_at({POWERS}, int({rows_after}) + 1), "
        f"pow({DECAY!r}D, {rows_after}))"
    )


def last_mean(tail_sum: str, n: str) -> str:
    return f"{tail_sum} * {1.0 - DECAY!r}D / (1 - pow({DECAY!r}D, {n}))"


def average_mean(head_sum: str, tail_sum: str, n: str) -> str:
    return f"({head_sum} - {head_weight(f'{n} + 1')} * {tail_sum} * {DECAY!r}D) / {n}"


# A block of rows that starts after ``o`` others weighs its k-th row by T(o + k). As a
# matrix over o and k that is 1 plus a sum of RANK products a_r(o) b_r(k), to double
# precision, so RANK weighted sums of a block hold what every offset needs.
RANK = 11


@cache
def _offset_factors() -> tuple[list[str], list[str]]:
    """Each ``a_r`` and ``b_r`` as an SQL array of HEAD numbers."""
    weights, following = np.ones(2 * HEAD + 1), 1.0
    for j in range(4 * HEAD, 0, -1):
        following = (1.0 - DECAY) / (1.0 - DECAY**j) + DECAY * following
        if j <= 2 * HEAD:
            weights[j] = following
    places = np.arange(1, HEAD + 1)
    left, values, right = np.linalg.svd(weights[places[:, None] + places] - 1.0)
    # A string is one literal in a plan, where an array of literals is hundreds.
    return tuple(
        ["cast(split('{}', ',') AS array<double>)".format(",".join(map(repr, row.tolist()))) for row in table[:RANK]]
        for table in ((left * values).T, right)
    )


def block_folds(x: str, position: str) -> list[str]:
    """SQL aggregates of a block: its values weighed by each ``b_r``."""
    _, b = _offset_factors()
    return [f"sum(if({position} <= {HEAD}, {x} * {row}[int({position}) - 1], 0D))" for row in b]


def offset_head(total: str, head: str, folds: str, offset: str) -> str:
    """What a block with these sums adds to the head sum after ``offset`` rows.
    ``head`` is its own head sum, as if it came first."""
    a, _ = _offset_factors()
    terms = " + ".join(f"{folds}[{r}] * {row}[int({offset}) - 1]" for r, row in enumerate(a))
    return f"if({offset} = 0, {head}, {total} + if({offset} <= {HEAD}, {terms}, 0D))"
