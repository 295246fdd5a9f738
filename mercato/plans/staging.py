"""Raw tables to staging: column selection, spelling, and the cleaned geolocation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.constants import BOUNDING_BOX
from mercato.functions.exprs import in_box
from mercato.schemas import TABLES

# raw spelling -> staging spelling
RENAMED = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}


def stage(name: str, raw: DataFrame) -> DataFrame:
    """The declared columns only, which drops load audit columns."""
    return raw.select(*TABLES[name].columns)


def stage_products(raw: DataFrame) -> DataFrame:
    return stage("products", raw).withColumnsRenamed(RENAMED)


def stage_geolocation(raw: DataFrame) -> DataFrame:
    """Distinct places inside the bounding box; filtered before the distinct."""
    inside = in_box("geolocation_lat", "geolocation_lng", BOUNDING_BOX)
    return stage("geolocation_raw", raw).filter(inside).distinct()


def build_staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All nine staging tables; the cleaned places are named ``geolocation``."""
    special = {"products": ("products", stage_products), "geolocation_raw": ("geolocation", stage_geolocation)}
    staged = {}
    for name, df in raw.items():
        out, build = special.get(name, (name, lambda d, n=name: stage(n, d)))
        staged[out] = build(df)
    return staged


def geo_by_zip(geolocation: DataFrame) -> DataFrame:
    """Mean coordinates per zip prefix over the cleaned places."""
    return geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        F.avg("geolocation_lat").alias("lat"),
        F.avg("geolocation_lng").alias("lng"),
    )
