"""A keyed permutation of positions, computed per row: shuffled orders without a sort.

A position ``x`` of ``count`` is a pair in a grid of ``a`` by ``b`` cells that just holds ``count``. Feistel
rounds add a keyed hash of one part to the other, so they permute the cells; a position that comes out
beyond ``count`` goes through the rounds again (cycle walking) until it is inside. Both directions are plain
column expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 4
MOST_WALKS = 64  # a grid has fewer cells to spare than its shorter side, so walks are short


def _grid(count: Column) -> tuple[Column, Column]:
    """Sides of the grid: the square root rounded up, and as many rows as are needed."""
    a = F.greatest(F.lit(1), F.ceil(F.sqrt(count))).cast("bigint")
    return a, F.greatest(F.lit(1).cast("bigint"), F.call_function("div", count + a - 1, a))


def _hash(key: Column, turn: int, part: Column) -> Column:
    """A keyed number below 2^60."""
    word = F.substring(F.md5(F.concat_ws(":", key, F.lit(str(turn)), part.cast("string"))), 1, 15)
    return F.conv(word, 16, 10).cast("bigint")


def _step(state: Column, key: Column, n: int, sign: int) -> Column:
    """One turn; even turns move the first part, odd ones the second."""
    p, q, a, b = (state[c] for c in "pqab")
    if n % 2 == 0:
        p = F.pmod(p + F.lit(sign) * (_hash(key, n, q) % a), a)
    else:
        q = F.pmod(q + F.lit(sign) * (_hash(key, n, p) % b), b)
    return F.struct(p.alias("p"), q.alias("q"), a.alias("a"), b.alias("b"))


def _turn(key: Column, n: int, sign: int) -> Callable[[Column], Column]:
    return lambda state: _step(state, key, n, sign)


def _walk(x: Column, count: Column, key: Column, turns: list[int], sign: int) -> Column:
    a, b = _grid(count)

    def rounds(state: Column) -> Column:
        # A lambda per turn, so that what a turn gives is computed once.
        held = F.array(state)
        for n in turns:
            held = F.transform(held, _turn(key, n, sign))
        return held[0]

    start = F.struct(F.call_function("div", x, b).alias("p"), (x % b).alias("q"), a.alias("a"), b.alias("b"))
    place = lambda s: s["p"] * s["b"] + s["q"]
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(MOST_WALKS)), start, lambda s, i: F.when((i > 1) & (place(s) < count), s).otherwise(rounds(s)), place
    )
    return F.when(walked < count, walked).otherwise(F.raise_error(F.lit("no position inside after all walks")))


def permuted(position: Column, count: Column, key: Column) -> Column:
    """Where a keyed shuffle of ``count`` positions puts ``position``: a bijection for every key."""
    return _walk(position.cast("bigint"), count.cast("bigint"), key, list(range(ROUNDS)), 1)


def unpermuted(place: Column, count: Column, key: Column) -> Column:
    """The position that ``permuted`` puts at ``place``."""
    return _walk(place.cast("bigint"), count.cast("bigint"), key, list(reversed(range(ROUNDS))), -1)
