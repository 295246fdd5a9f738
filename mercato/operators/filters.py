"""Dashboard filters: date range, states, categories, and their option lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.frames import union_all

DATE, STATE, CATEGORY = "order_purchase_date", "customer_state", "product_category_name_english"

MONTH = "order_month"  # first day of the order date's month, in facts stored by month

ALL = "all"  # every listed option chosen: drops only rows without a value


@dataclass(frozen=True)
class Selection:
    """What a dashboard user picked.

    ``date_range`` counts only with exactly two dates. For ``states`` and ``categories``, nothing chosen
    means no filter, so rows without a value stay; ``ALL`` (the widgets' default) or a list drops them.
    """

    date_range: Sequence[date] | None = None
    states: Sequence[str] | str | None = None
    categories: Sequence[str] | str | None = None


def filter_by_date(df: DataFrame, selection: Selection, date_col: str = DATE) -> DataFrame:
    """Inclusive range; without two bounds every dated row stays. Facts stored by month are also asked for the range's
    months, which their scans, and those of facts joined to them by month, prune folders with."""
    bounds = selection.date_range
    if bounds and len(bounds) == 2:
        if MONTH in df.columns:
            df = df.filter(F.col(MONTH).between(F.lit(bounds[0].replace(day=1)), F.lit(bounds[1])))
        return df.filter(F.col(date_col).between(F.lit(bounds[0]), F.lit(bounds[1])))
    return df.filter(F.col(date_col).isNotNull())


def _chosen(df: DataFrame, column: str, options: Sequence[str] | str | None) -> DataFrame:
    if not options:
        return df
    if options == ALL:
        return df.filter(F.col(column).isNotNull())
    return df.filter(F.col(column).isin(list(options)))


def filter_by_date_and_state(df: DataFrame, selection: Selection, state_col: str = STATE) -> DataFrame:
    return _chosen(filter_by_date(df, selection), state_col, selection.states)


def filter_by_date_and_category(df: DataFrame, selection: Selection, category_col: str = CATEGORY) -> DataFrame:
    return filter_by_category(filter_by_date(df, selection), selection, category_col)


def filter_by_category(df: DataFrame, selection: Selection, category_col: str = CATEGORY) -> DataFrame:
    return _chosen(df, category_col, selection.categories)


def filter_options(orders: DataFrame, products_sold: DataFrame) -> DataFrame:
    """Choices offered: first and last order date, sorted states, and sorted categories of products sold."""
    bounds = orders.agg(F.min(DATE).alias("first"), F.max(DATE).alias("last")).selectExpr(
        "stack(2, 'min_date', CAST(first AS STRING), 'max_date', CAST(last AS STRING)) AS (filter, option)")
    states = orders.select(F.lit("state").alias("filter"), F.col(STATE).alias("option"))
    categories = products_sold.select(F.lit("category").alias("filter"), F.col(CATEGORY).alias("option"))
    listed = [df.filter(F.col("option").isNotNull()).distinct() for df in (states, categories)]
    return union_all([bounds, *listed]).orderBy("filter", "option")
