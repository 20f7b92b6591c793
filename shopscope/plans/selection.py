"""Exact order statistics by counting, without a sort.

The value at a rank (a quantile, a median, the border of a score) needs no
order of the rows. For all ranks of all measures together:

1. One aggregate sketches every measure (count, minimum, maximum and the
   approximate values next to each wanted rank).
2. One aggregate counts, exactly, the rows below and up to each proposed
   value. The counts settle between which two values a rank lies; a rank that
   falls on a value that many rows share is settled at once.
3. The rows strictly between the two values, a few ten-thousandths of the
   table, are collected when they are at most ``AT_MOST``; otherwise steps 1
   and 2 run again on them alone. The middle of the interval is always among
   the proposed values, so each turn halves it even where the sketch is too
   coarse (it works in doubles) to tell the values apart.

The sketch only proposes. Every pass is an aggregate with map-side partials of
bounded size: nothing is shuffled but the partials, however skewed the values.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from decimal import Context, Decimal, localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: One over the sketch's rank error.
ACCURACY = 10_000
#: Rows between two counted values that the driver may collect, per rank.
AT_MOST = 5_000


@dataclass(frozen=True)
class Rank:
    """One or several neighbouring ranks (from 1) of a measure with n values: about the share ``near`` of
    them, exactly ``of(n)``."""

    near: float
    of: Callable[[int], Sequence[int]]


def quantile(q: float) -> Rank:
    """The neighbours of position (n - 1) q."""
    return Rank(q, lambda n: sorted({math.floor((n - 1) * q) + 1, math.ceil((n - 1) * q) + 1}))


@dataclass(frozen=True)
class Place:
    """A value at a rank, how many rows have a smaller one, and how many that or a smaller one."""

    value: object
    below: int
    upto: int


@dataclass
class _Target:
    value: Column
    kind: T.DataType
    near: float
    ranks: list[int] = field(default_factory=list)
    #: what has been counted: value -> (rows below, rows up to it)
    counted: dict = field(default_factory=dict)
    proposed: list = field(default_factory=list)
    between: list | None = None

    def around(self) -> tuple[object, object]:
        """The nearest counted values that enclose all ranks."""
        low = max(v for v, (below, _) in self.counted.items() if below < self.ranks[0])
        high = min(v for v, (_, upto) in self.counted.items() if upto >= self.ranks[-1])
        return low, high

    def open_rows(self) -> int:
        """Rows strictly between those, 0 if no rank falls there."""
        low, high = self.around()
        after, before = self.counted[low][1], self.counted[high][0]
        return max(before - after, 0) if any(after < r <= before for r in self.ranks) else 0

    def inside(self) -> Column:
        low, high = (self.literal(v) for v in self.around())
        return F.when((self.value > low) & (self.value < high), self.value)

    def literal(self, v) -> Column:
        return F.lit(v).cast(self.kind)

    def middle(self):
        """The middle of the widest gap between the counted values around the ranks."""
        low, high = self.around()
        known = sorted(v for v in self.counted if low <= v <= high)
        a, b = max(zip(known, known[1:]), key=lambda ab: ab[1] - ab[0], default=(low, high))
        if isinstance(a, Decimal):
            step = Decimal(1).scaleb(-self.kind.scale)
            return ((a + b) / 2 // step) * step
        return (a + b) / 2 if isinstance(a, float) else (a + b) // 2

    def propose(self, values: Sequence) -> None:
        low, high = self.around()
        with localcontext(Context(prec=80)):
            if isinstance(low, Decimal):
                values = [Decimal(v).quantize(Decimal(1).scaleb(-self.kind.scale)) for v in values if v is not None]
            values = [*values, self.middle()]
        self.proposed = sorted({v for v in values if v is not None and low <= v <= high} - set(self.counted))

    def place(self, rank: int) -> Place:
        for v, (below, upto) in self.counted.items():
            if below < rank <= upto:
                return Place(v, below, upto)
        after = self.counted[self.around()[0]][1]
        value = self.between[rank - after - 1]
        return Place(value, after + bisect_left(self.between, value), after + bisect_right(self.between, value))


def _row(df: DataFrame, columns: list[Column]) -> list:
    return list(df.agg(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def order_statistics(df: DataFrame, wanted: dict[str, tuple[Column, Sequence[Rank]]], *,
                     accuracy: int = ACCURACY, at_most: int = AT_MOST) -> dict[str, tuple[int, list[dict[int, Place]]]]:
    """Per measure the number of its values and, for each ``Rank``, its ranks with their places.

    ``wanted``: name -> (numeric column, ranks). Nulls take no part, so a measure may be restricted to
    some rows by a CASE. A measure without values has no places.
    """
    margin = 2 / accuracy
    names = list(wanted)
    kinds = dict(zip(names, (f.dataType for f in df.select(*[wanted[m][0].alias(f"m{i}") for i, m in enumerate(names)]).schema)))
    columns = []
    for m in names:
        value, ranks = wanted[m]
        shares = sorted({min(max(s, 0.0), 1.0) for r in ranks for s in (r.near - margin, r.near + margin)})
        columns += [F.count(value), F.min(value), F.max(value), F.percentile_approx(value, F.array(*map(F.lit, shares)), F.lit(accuracy))]
    got = _row(df, columns)
    targets: dict[str, list[_Target]] = {}
    sizes: dict[str, int] = {}
    for i, m in enumerate(names):
        n, least, most, sketch = got[4 * i:4 * i + 4]
        targets[m], sizes[m] = [], n
        for r in wanted[m][1] if n else []:
            t = _Target(wanted[m][0], kinds[m], r.near, sorted(r.of(n)), {least: (0, n)} if least == most else {least: (0, 0), most: (n, n)})
            shares = sorted({min(max(s, 0.0), 1.0) for x in wanted[m][1] for s in (x.near - margin, x.near + margin)})
            t.propose([v for s, v in zip(shares, sketch) if abs(s - r.near) <= 1.5 * margin])
            t.proposed = sorted({least, most, *t.proposed})
            targets[m].append(t)
    flat = [t for ts in targets.values() for t in ts]
    todo = flat
    while todo:
        got = _row(df, [c for t in todo for v in t.proposed for c in (F.count_if(t.value < t.literal(v)), F.count_if(t.value <= t.literal(v)))])
        for t in todo:
            for v in t.proposed:
                t.counted[v] = (got.pop(0), got.pop(0))
        todo = [t for t in todo if t.open_rows() > at_most]
        if not todo:
            break
        columns = []
        for t in todo:
            rows, after = t.open_rows(), t.counted[t.around()[0]][1]
            share = (t.ranks[0] - after) / rows
            columns.append(F.percentile_approx(t.inside(), F.array(*[F.lit(min(max(s, 0.0), 1.0)) for s in (share - margin, share + margin)]), F.lit(accuracy)))
        for t, sketch in zip(todo, _row(df, columns)):
            t.propose(sketch or [])
    few = [t for t in flat if t.open_rows()]
    if few:
        for t, values in zip(few, _row(df, [F.collect_list(t.inside()) for t in few])):
            t.between = sorted(values)
    return {m: (sizes[m], [{r: t.place(r) for r in t.ranks} for t in targets[m]]) for m in names}


def interpolated(n: int, q: float, places: dict[int, Place]) -> float:
    """The quantile between the neighbours of position (n - 1) q, in doubles."""
    p = (n - 1) * q
    lo, hi = math.floor(p), math.ceil(p)
    a, b = float(places[lo + 1].value), float(places[hi + 1].value)
    return a if a == b else (hi - p) * a + (p - lo) * b


def quantiles(df: DataFrame, wanted: dict[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns in the same passes, with linear interpolation between closest
    ranks (the rule of pandas' default and of SQL percentile_cont); null for a column without values."""
    found = order_statistics(df, {c: (F.col(c), [quantile(q) for q in qs]) for c, qs in wanted.items()})
    return {c: [interpolated(found[c][0], q, places) for q, places in zip(qs, found[c][1])] or [None] * len(qs) for c, qs in wanted.items()}


def middle(n: int) -> list[int]:
    """The ranks of the median's one or two values."""
    return sorted({(n + 1) // 2, n // 2 + 1})


def medians(df: DataFrame, wanted: dict[str, Column]) -> dict[str, tuple[object, int] | None]:
    """Per measure (sum, number) of its one or two middle values."""
    found = order_statistics(df, {m: (c, [Rank(0.5, middle)]) for m, c in wanted.items()})
    out = {}
    for m, (n, places) in found.items():
        values = [p.value for p in places[0].values()] if places else []
        out[m] = (sum(values), len(values)) if values else None
    return out


def at_ranks(df: DataFrame, first: str, second: str, ranks: Sequence[Rank], descending: bool = False) -> tuple[int, list[tuple[object, object]]]:
    """(n, [(first, second) of the row at each rank]) in the order of ``first`` (descending or not), then
    ``second`` ascending: the value of ``first``, then the rank among the rows that share it."""
    value = -F.col(first) if descending else F.col(first)
    n, places = order_statistics(df, {"v": (value, ranks)})["v"]
    if not places:
        return n, []
    kind = df.select(value.alias("v")).schema[0].dataType
    at = [(rank, p) for found in places for rank, p in found.items()]
    tied = {str(i): (F.when(value == F.lit(p.value).cast(kind), F.col(second)), [Rank((rank - p.below - 0.5) / (p.upto - p.below), lambda _, k=rank - p.below: [k])])
            for i, (rank, p) in enumerate(at)}
    within = order_statistics(df, tied)
    return n, [(-p.value if descending else p.value, within[str(i)][1][0][rank - p.below].value) for i, (rank, p) in enumerate(at)]
