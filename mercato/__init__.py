"""Marketplace analytics as lazy Spark DataFrame plans."""

from mercato.schemas import TABLES, TableSpec
from mercato.session import get_spark

__all__ = ["TABLES", "TableSpec", "get_spark"]
