"""Star-schema reporting: area flags, labelled spend with median, spend on a
category, daily averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.aggregate import exact_median
from quarry.operators.join import join_small


def area_flags(
    customers: DataFrame, prefixes: DataFrame, postal: Column, prefix_col: str = "pcprefix", keep: Sequence[str] = ()
) -> DataFrame:
    """``(custid, *keep, in_area)``: 1 when the customer's postal prefix is in
    the prefix list.  The DISTINCT prefix list is bounded by the postal
    system (a few thousand codes) and is broadcast behind a guard of its size;
    ``keep`` carries customer columns through, so callers need no second
    scan and join of the customer table."""
    vp = prefixes.select(F.col(prefix_col).alias("_vp")).distinct()
    joined = join_small(customers.withColumn("_pp", postal), vp, F.col("_pp") == F.col("_vp"), "left", strategy="broadcast")
    return joined.select("custid", *keep, F.when(F.col("_vp").isNotNull(), 1).otherwise(0).alias("in_area"))


def spend_by_label(purchases: DataFrame, label: Column, amount: str = "amount", key: str = "custid") -> DataFrame:
    """``(region, number_of_purchases, average_of_purchase, median_of_purchase)``
    per computed label (a CASE without ELSE: unmatched rows form a NULL group)."""
    labelled = purchases.select(label.alias("region"), F.col(key), F.col(amount))
    out = exact_median(
        labelled,
        ["region"],
        amount,
        alias="median_of_purchase",
        extra={"number_of_purchases": F.count(key), "average_of_purchase": F.avg(amount)},
        carry=[key],
    )
    return out.select("region", "number_of_purchases", "average_of_purchase", "median_of_purchase")


def category_spend(
    purchases: DataFrame,
    flags: DataFrame,
    items: DataFrame,
    flag: str = "in_area",
    form: str = "join",
    link: DataFrame | None = None,
    link_on: str | Column | None = None,
) -> DataFrame:
    """Average purchase per customer flag, over purchases of selected items.

    ``items`` holds the selected item ids (``amenid``).  ``form='join'`` is an
    inner join; ``form='distinct'`` joins a DISTINCT id list (a semi-join in
    effect); both agree when item ids are unique.  The selection is applied
    to purchases first, so every later (shuffle) join sees only matching
    rows.  ``link`` optionally attaches ``custid`` after the selection (e.g.
    line items -> orders).
    """
    if form == "join":
        chosen = purchases.join(items.select("amenid"), "amenid")
    elif form == "distinct":
        chosen = purchases.join(items.select("amenid").distinct(), "amenid", "left_semi")
    else:
        raise ValueError(form)
    if link is not None:
        chosen = chosen.join(link, link_on)
    return chosen.join(flags, "custid").groupBy(flag).agg(F.avg("amount").alias("average_amount"))


def like_any(text: Column, patterns: Sequence[str]) -> Column:
    """Lower-cased text LIKE any of the patterns."""
    low = F.lower(text)
    cond = None
    for p in patterns:
        c = low.like(p)
        cond = c if cond is None else cond | c
    return cond


def average_per_day(purchases: DataFrame, date: str, amount: str, month: int, first_day: int, last_day: int) -> DataFrame:
    """``(pdate, average_amount)`` for days ``first_day..last_day`` of a month,
    any year."""
    d = F.to_date(F.col(date))
    return (
        purchases.where((F.month(d) == month) & F.dayofmonth(d).between(first_day, last_day))
        .groupBy(d.alias("pdate"))
        .agg(F.avg(amount).alias("average_amount"))
    )
