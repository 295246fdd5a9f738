"""Builds that publish only what was checked, and stored snapshot runs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from mercato.operators.history import snapshot_check
from mercato.operators.quality import Check, judge, run_checks
from mercato.session import Scratch
from mercato.sources.tables import HistoryTable, VersionedTable


def gated_build(
    marts: dict[str, tuple[VersionedTable, DataFrame]], checks: list[Check], others: dict[str, DataFrame] | None = None,
    depends: Mapping[str, Iterable[str]] | None = None,
) -> list[str]:
    """Stage all marts, check the staged files, and only then make them current.

    What is published is what was checked. A failed check of severity ``error`` raises after the rest of the build.
    ``depends`` names the tables that each mart is made of: a failure withholds the table it is found in and all that
    depend on it, and the others are published. Without it, a failure withholds every mart. A withheld table stays at
    its version; its staged folder is never pointed to. ``others`` are tables that checks refer to besides the marts.
    Returns the names of checks that only warn.
    """
    staged = {name: (table, table.version, table.stage(df)) for name, (table, df) in marts.items()}
    written = {name: table.read_staged(folder) for name, (table, _, folder) in staged.items()}
    report = run_checks({**(others or {}), **written}, checks).collect()  # a row a check
    withheld = {row["table_name"] for row in report if row["status"] == "error"}
    if withheld and depends is None:
        withheld |= set(marts)
    while more := {name for name, made_of in (depends or {}).items() if withheld & set(made_of)} - withheld:
        withheld |= more
    for name, (table, base, folder) in staged.items():
        if name not in withheld:
            table.switch(folder, base)
    return judge(report)


def snapshot_run(table: HistoryTable, src: DataFrame, key: str, check_cols: list[str], as_of: datetime) -> int:
    """Bring a stored type-2 history up to ``src`` as of a time; returns the number of its runs.

    Only the open versions are compared and replaced, and the ones that this run closes are added to the closed ones.
    A run at or before the last one's time is a replay and changes nothing.
    """
    run = int(as_of.replace(tzinfo=timezone.utc).timestamp())
    if table.last_run >= run:
        return table.open.version
    known = table.open.read() if table.open.version else None
    with Scratch(src.sparkSession) as scratch:  # both sides are written from one comparison
        return table.replace(scratch.materialise(snapshot_check(known, src, key, check_cols, as_of), "advanced"), run)
