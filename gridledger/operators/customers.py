"""Customer and transaction reports.

Joins never meet raw transactions by shuffle: either the customer side is measured small and
broadcast, so transactions are not shuffled at all, or transactions are first reduced to one row
per customer. A customer holding a third of all transactions costs one row per task either way,
and a customer ID repeated without bound meets one row, which AQE can replicate to split it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import age_band
from ..functions.money import MONEY_DIGITS, money_aggregates, money_columns, money_merge, money_total
from ..functions.sizing import BROADCAST_BYTES, fits_broadcast


_SAME = {"units": "units", "odd": "odd", "plain": "plain"}

# What the combined key says where a customer's age or gender is not known.
_NO_AGE, _NO_GENDER = "Unknown", "unknown"


def _named(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(f"{sql} as {name}") for name, sql in expressions.items()]


def customer_txn_summary(
    customers: DataFrame, transactions: DataFrame, money_digits: int | None = MONEY_DIGITS
) -> DataFrame:
    """Name, salary, transaction count, total spent and least items for every customer ID.

    IDs of either table appear: without transactions the three measures are 0, without a customer
    the name is empty and the salary 0. Several rows of one customer ID give one result row, with
    the greatest (Name, Salary). Both sides are reduced on the join key first, so the full outer
    join reuses their partitioning and adds no shuffle. Rows without an ID are left out.
    """
    spent = (
        transactions.where("CustID is not null")
        .groupBy(F.expr("CustID as ID"))
        .agg(
            F.expr("count(*) as n"),
            *_named(money_aggregates("TransTotal", money_digits)),
            F.expr("min(TransNumItems) as least"),
        )
    )
    people = (
        customers.where("ID is not null")
        .groupBy("ID")
        .agg(F.expr("max(struct(Name, Salary)) as person"))
    )
    return people.join(spent, "ID", "full_outer").selectExpr(
        "ID",
        "coalesce(person.Name, '') as Name",
        "coalesce(person.Salary, 0D) as Salary",
        "coalesce(n, 0L) as NumTransactions",
        f"coalesce({money_total(_SAME, money_digits)}, 0D) as TotalSum",
        "coalesce(least, 0) as MinItems",
    )


def country_txn_report(
    customers: DataFrame, transactions: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Customer count and least and greatest transaction total of each country.

    Both totals are 0 for a country without transactions. Transactions of unknown customers are
    left out. A customer ID on several rows is looked up once, with its greatest country code, but
    each row counts as a customer.
    """
    located = customers.where("CountryCode is not null")
    counts = located.groupBy("CountryCode").agg(F.expr("count(*) as CustomerCount"))

    # Measured on the raw rows, an upper bound of the lookup's size.
    pairs = located.where("ID is not null").select("ID", "CountryCode")
    lookup = pairs.groupBy("ID").agg(F.expr("max(CountryCode) as CountryCode"))
    if fits_broadcast(pairs, broadcast_bytes):
        ranges = transactions.selectExpr("CustID as ID", "TransTotal as low", "TransTotal as high")
        lookup = F.broadcast(lookup)
    else:
        ranges = (
            transactions.where("CustID is not null")
            .groupBy(F.expr("CustID as ID"))
            .agg(F.expr("min(TransTotal) as low"), F.expr("max(TransTotal) as high"))
        )
    totals = (
        ranges.join(lookup, "ID")
        .groupBy("CountryCode")
        .agg(F.expr("min(low) as low"), F.expr("max(high) as high"))
    )
    return counts.join(totals, "CountryCode", "left").selectExpr(
        "CountryCode",
        "CustomerCount",
        "coalesce(low, 0D) as MinTransTotal",
        "coalesce(high, 0D) as MaxTransTotal",
    )


def age_gender_spend(
    customers: DataFrame,
    transactions: DataFrame,
    combined_key: bool = True,
    money_digits: int | None = MONEY_DIGITS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Least, greatest and average transaction total for each age band and gender.

    ``combined_key=True`` is the lookup form: one key ``"[10,20) male"``, a customer ID on several
    rows is looked up once (greatest age and gender), ages outside the bands, or null, are ``Unknown``
    and a null gender is ``unknown``.
    ``combined_key=False`` is the join form: columns AgeRange and Gender, a transaction counts once
    for each customer row of its ID, ages outside the bands are ``UNKNOWN``; nulls stay null.
    Transactions of unknown customers are left out.
    """
    known = customers.where("ID is not null").select("ID", "Age", "Gender")
    if combined_key:
        traits = (
            known.groupBy("ID")
            .agg(F.expr("max(struct(Age, Gender)) as t"))
            .selectExpr(
                "ID",
                f"concat(coalesce({age_band('t.Age', 'Unknown')}, '{_NO_AGE}'), ' ', "
                f"coalesce(t.Gender, '{_NO_GENDER}')) as AgeGender",
            )
        )
    else:
        traits = known.selectExpr("ID", f"{age_band('Age')} as AgeRange", "Gender")

    if fits_broadcast(known, broadcast_bytes):
        spent = transactions.selectExpr(
            "CustID as ID",
            "TransTotal as low",
            "TransTotal as high",
            *[f"{sql} as {name}" for name, sql in money_columns("TransTotal", money_digits).items()],
            "if(TransTotal is null, 0L, 1L) as n",
        )
        traits = F.broadcast(traits)
    else:
        spent = (
            transactions.where("CustID is not null")
            .groupBy(F.expr("CustID as ID"))
            .agg(
                F.expr("min(TransTotal) as low"),
                F.expr("max(TransTotal) as high"),
                *_named(money_aggregates("TransTotal", money_digits)),
                F.expr("count(TransTotal) as n"),
            )
        )

    total = money_total(money_merge(money_digits), money_digits)
    key = ["AgeGender"] if combined_key else ["AgeRange", "Gender"]
    report = (
        spent.join(traits, "ID")
        .groupBy(*key)
        .agg(
            F.expr("min(low) as MinTransTotal"),
            F.expr("max(high) as MaxTransTotal"),
            # nullif: a group whose totals are all null has no average
            F.expr(f"({total}) / nullif(sum(n), 0) as AvgTransTotal"),
        )
    )
    if not combined_key:
        return report
    return report.selectExpr(
        "AgeGender",
        *[f"coalesce({m}, 0D) as {m}" for m in ("MinTransTotal", "MaxTransTotal", "AvgTransTotal")],
    )


def least_active_customers(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Name and transaction count of the customers with the fewest transactions, ties kept.

    Customers without transactions do not appear. IDs missing from ``customers`` take part in the
    minimum but not in the result; rows without an ID in neither. The minimum is a scalar subquery
    over the same aggregate, whose scan and shuffle Spark reuses, and cuts the counts down before
    the join.
    """
    counts = (
        transactions.where("CustID is not null")
        .groupBy(F.expr("CustID as ID"))
        .agg(F.expr("count(TransID) as TransCount"))
    )
    fewest = counts.agg(F.expr("min(TransCount)")).scalar()
    least = counts.where(F.col("TransCount") == fewest)
    return customers.join(least, "ID").select("Name", "TransCount")


def country_size_outliers(customers: DataFrame, hi: int = 5000, lo: int = 2000) -> DataFrame:
    """Countries with more than ``hi`` or fewer than ``lo`` customers."""
    return (
        customers.groupBy("CountryCode")
        .agg(F.expr("count(ID) as NumCustomers"))
        .where(f"NumCustomers > {int(hi)} or NumCustomers < {int(lo)}")
    )
