"""Small DataFrame helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name of many parts, paired as a balanced tree: every union re-analyses what is below it."""
    parts = list(parts)
    while len(parts) > 1:
        pairs = [parts[i:i + 2] for i in range(0, len(parts), 2)]
        parts = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return parts[0]


def to_lines(one_row: DataFrame, lines: Sequence[dict[str, str]]) -> DataFrame:
    """Turn a one-row aggregate into one row per line; a line maps output columns to SQL expressions."""
    structs = ["named_struct(" + ", ".join(f"'{k}', {v}" for k, v in line.items()) + ")" for line in lines]
    return one_row.selectExpr(f"inline(array({', '.join(structs)}))")
