"""Totals of money columns, independent of how rows were split over tasks wherever that is exact.

Summing doubles gives a result that depends on the order of rows. Amounts are mostly written with
a few decimals, so the same aggregate keeps three things: the sum in whole units of 10**-digits
(BIGINT), whether any amount is not such a number of units or out of range, and the plain sum. The
units are used only if every amount was whole and they did not overflow; else the plain sum, which
is then what adding up the doubles gives (also for NaN and infinity). All functions take and give
SQL text; ``digits=None`` keeps to plain sums.
"""

from __future__ import annotations

# Decimals that totals are exact for, unless told otherwise.
MONEY_DIGITS = 4


def money_columns(amount: str, digits: int | None) -> dict[str, str]:
    """What one row brings to a total: for ``money_merge`` to add up."""
    if digits is None:
        return {"plain": amount}
    scale = f"{10**digits}D"
    whole = f"(abs({amount}) < {10 ** (14 - digits)}D and rint({amount} * {scale}) / {scale} = {amount})"
    return {
        "units": f"case when {amount} is null then null when {whole} then cast(rint({amount} * {scale}) as bigint) else 0L end",
        "odd": f"{amount} is not null and not {whole}",
        "plain": amount,
    }


def money_aggregates(amount: str, digits: int | None) -> dict[str, str]:
    """Aggregates over an amount column; their results can be merged further."""
    columns = money_columns(amount, digits)
    if digits is None:
        return {"plain": f"sum({columns['plain']})"}
    return {
        "units": f"try_sum({columns['units']})",
        "odd": f"bool_or({columns['odd']})",
        "plain": f"sum({columns['plain']})",
    }


def money_merge(digits: int | None) -> dict[str, str]:
    """Aggregates over columns units, odd and plain. Units lost to overflow count as odd."""
    if digits is None:
        return {"plain": "sum(plain)"}
    return {
        "units": "try_sum(units)",
        "odd": "bool_or(odd or (units is null and plain is not null))",
        "plain": "sum(plain)",
    }


def money_total(parts: dict[str, str], digits: int | None) -> str:
    """The total as a double, from expressions for units, odd and plain; null without an amount."""
    if digits is None:
        return parts["plain"]
    exact = f"not coalesce({parts['odd']}, false) and ({parts['units']}) is not null"
    return f"if({exact}, ({parts['units']}) / {10**digits}D, {parts['plain']})"
