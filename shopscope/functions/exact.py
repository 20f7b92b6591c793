"""Exact decimal arithmetic as Column expressions.

Money is DECIMAL end to end. A rounded ratio ``round(num * mult / den, n)``
is computed on integers: with P = num * mult * 10^(n + den_scale) and
Q = den * 10^num_scale (both exact integers),

    half-up:   R = sign * ((2|P| + |Q|) div (2|Q|))
    half-even: R = |P| div |Q|, plus 1 when the remainder is above half, or
               exactly half and R is odd

and the result is R * 10^-n. Nothing goes through floating point, so the
value depends neither on summation order nor on the engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _ratio_text(num: str, den: str, places: int, num_scale: int, den_scale: int,
                mult: int, half_even: bool, precision: int) -> str:
    i, div = "DECIMAL(38,0)", "div"
    # the operand is a wide decimal before anything multiplies it: a BIGINT product could overflow
    wide = lambda x, s: f"CAST(CAST(({x}) AS DECIMAL(38,{s})) * {10 ** s} AS {i})"
    p = f"({wide(num, num_scale)} * {mult * 10 ** (places + den_scale)})"
    q = f"({wide(den, den_scale)} * {10 ** num_scale})"
    ap, aq = f"abs({p})", f"abs({q})"
    if half_even:
        base = f"({ap} {div} {aq})"
        rem2 = f"(({ap} - {base} * {aq}) * 2)"
        r = (f"(CASE WHEN {rem2} > {aq} THEN {base} + 1 "
             f"WHEN {rem2} = {aq} AND {base} % 2 = 1 THEN {base} + 1 ELSE {base} END)")
    else:
        r = f"((2 * {ap} + {aq}) {div} (2 * {aq}))"
    signed = f"(CASE WHEN ({p} < 0) <> ({q} < 0) THEN -{r} ELSE {r} END)"
    if places:
        unit = f"CAST('{10 ** -places:.{places}f}' AS DECIMAL({places + 1},{places}))"
        scaled = f"(CAST({signed} AS DECIMAL({precision - places - 1},0)) * {unit})"
    else:
        scaled = signed
    return (f"CAST(CASE WHEN {q} = 0 THEN NULL ELSE {scaled} END "
            f"AS DECIMAL({precision},{places}))")


def ratio(num: str, den: str, places: int, *, num_scale: int = 0, den_scale: int = 0,
          mult: int = 1, half_even: bool = False, precision: int = 38) -> Column:
    """round(num * mult / den, places) exactly; NULL when den is 0.

    ``num``/``den`` are Spark SQL expressions (usually column names) whose
    values have at most ``num_scale``/``den_scale`` decimal places.
    """
    return F.expr(_ratio_text(num, den, places, num_scale, den_scale, mult,
                              half_even, precision))


def money(c, scale: int = 2, precision: int = 38) -> Column:
    """Round a DECIMAL half-up to ``scale`` places (exact on decimals)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, scale).cast(f"decimal({precision},{scale})")


def money_even(c, scale: int = 2, precision: int = 38) -> Column:
    """Round a DECIMAL half-even to ``scale`` places."""
    c = F.col(c) if isinstance(c, str) else c
    return F.bround(c, scale).cast(f"decimal({precision},{scale})")

