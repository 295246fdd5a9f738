"""Slowly changing history (type 2) and point-in-time joins."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.exprs import instant
from mercato.operators.upsert import require_unique
from mercato.session import materialise

# fixed values: bounds of an interval that is open on one side
BEGINNING = datetime(1, 1, 1)
END_OF_TIME = datetime(9999, 12, 31)


def first_snapshot(src: DataFrame, as_of: datetime) -> DataFrame:
    """History after the first run: one open row per source row."""
    return src.withColumns({
        "valid_from": instant(as_of),
        "valid_to": F.lit(None).cast("timestamp_ntz"),
    })


def snapshot_check(
    prev: DataFrame | None, src: DataFrame, key: str, check_cols: list[str], as_of: datetime, validate: bool = True,
) -> DataFrame:
    """Next state of a type-2 history, by comparing the watched columns of open rows with the source.

    Unchanged rows stay open. A change (NULL-safe, in any watched column) closes the open row at ``as_of``
    and opens a new one. New keys open a row. Keys absent from the source stay open. Closed rows pass
    through untouched. Keys must be unique in the source, and have one open row each in the history.
    """
    if validate:
        require_unique(src, [key], "snapshot source")
    if prev is None:
        return first_snapshot(src, as_of)

    payload = [c for c in src.columns if c != key]
    is_open = F.col("valid_to").isNull()
    old = prev.filter(is_open).select(
        F.col(key), F.struct(*payload, "valid_from").alias("old"),
    )
    new = src.select(F.col(key), F.struct(*payload).alias("new"))
    both = old.join(new, key, "full_outer")

    changed = F.lit(False)
    for c in check_cols:
        changed = changed | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    moved = has_old & has_new & changed

    never = F.lit(None).cast("timestamp_ntz")
    version_type = "struct<" + ",".join(
        [f"`{c}`:{src.schema[c].dataType.simpleString()}" for c in payload]
        + ["valid_from:timestamp_ntz", "valid_to:timestamp_ntz"]) + ">"

    def version(side: str, valid_from: Column, valid_to: Column) -> Column:
        fields = [F.col(f"{side}.{c}").alias(c) for c in payload]
        return F.struct(*fields, valid_from.alias("valid_from"), valid_to.alias("valid_to")).cast(version_type)

    kept = F.when(has_old, version("old", F.col("old.valid_from"), F.when(moved, instant(as_of)).otherwise(never)))
    opened = F.when(moved | ~has_old, version("new", instant(as_of), never))
    versions = F.filter(F.array(kept, opened), lambda v: v.isNotNull())
    # one pass over the join: each key yields one row, or two when it moved
    advanced = both.select(F.col(key), F.inline(versions)).select(*prev.columns)
    return prev.filter(~is_open).unionByName(advanced)


def dim_scd2(snapshot: DataFrame) -> DataFrame:
    """History with ``is_current``, true for the open version of each key."""
    return snapshot.withColumn("is_current", F.col("valid_to").isNull())


def pit_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    closed: str = "both",
    backfill_first: bool = False,
    how: str = "inner",
) -> DataFrame:
    """Join each fact to the dimension version valid at its own time.

    ``closed="both"`` includes both ends of the interval, so a fact exactly at a change instant meets the
    old and the new version; ``"left"`` is half-open and gives at most one. ``backfill_first`` lets the first
    version of a key also cover everything before it. ``how`` is ``inner`` or ``left``.

    An equi-join with a range residual: versions of a measured small dimension are broadcast, otherwise
    the sort-merge join's skew splitting spreads a hot key's facts over tasks.
    """
    versions = _with_bounds(dim, key, backfill_first)
    left, right = fact.alias("fact"), versions.alias("dim")
    matched = (F.col(f"fact.{key}") == F.col(f"dim.{key}")) & _valid(F.col(f"fact.{ts}"), closed)
    return left.join(right, matched, how).select("fact.*", *_brought(fact, dim))


def _with_bounds(dim: DataFrame, key: str, backfill_first: bool) -> DataFrame:
    """Versions with ``_since`` and ``_until``, closed at both ends of time."""
    versions = dim.withColumn("_until", F.coalesce("valid_to", instant(END_OF_TIME)))
    if not backfill_first:
        return versions.withColumn("_since", F.col("valid_from"))
    # a grouped minimum, not a window: a key with very many versions stays one partial row per task
    firsts = dim.groupBy(key).agg(F.min("valid_from").alias("_first"))
    since = F.when(F.col("valid_from") == F.col("_first"), instant(BEGINNING)).otherwise(F.col("valid_from"))
    versions = versions.join(firsts, key).withColumn("_since", since).drop("_first")
    # written, so that the join with the facts stands on a scan and a hot key's facts can be split
    return materialise(versions, "versions-since")


def _valid(at: Column, closed: str) -> Column:
    if closed not in ("both", "left"):
        raise ValueError(f"closed must be 'both' or 'left', not {closed!r}")
    before_end = at <= F.col("dim._until") if closed == "both" else at < F.col("dim._until")
    return (at >= F.col("dim._since")) & before_end


def _brought(fact: DataFrame, dim: DataFrame) -> list[Column]:
    taken = set(fact.columns)
    return [F.col(f"dim.{c}") for c in dim.columns if c not in taken]


FEW_VERSIONS = 8  # of a key in a bucket: its facts meet them all, which costs no more than this many comparisons
SHARED_BUCKET = 2  # width of the buckets that all keys share, in mean versions: three versions for two are placed


def _seconds(at: Column) -> Column:
    """Whole seconds of a local time since 1970, the same in every session time zone."""
    days = F.date_diff(F.to_date(at), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(at) * 3600 + F.minute(at) * 60 + F.floor(F.second(at))


def bucketed_sides(
    fact: DataFrame, dim: DataFrame, key: str, ts: str, backfill_first: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Facts, and versions with ``_since`` and ``_until``, both with the time bucket ``_bucket`` of their key.

    Buckets of one width, ``SHARED_BUCKET`` times as long as a version lasts in the mean, serve all keys, so that neither
    side has to be sent to its key first. Keys with more than ``FEW_VERSIONS`` versions in such a bucket have buckets of
    their own, about as many as versions, of equal width between first and last change; they are few, as the width is the
    mean. Times before and after fall into the outer buckets. A version is in all buckets it overlaps, so rows grow to
    three times the versions at most, half as many again where buckets are shared; a fact is in one, so a match is met once.
    """
    versions = _with_bounds(dim, key, backfill_first)
    changed = _seconds(F.col("valid_from"))
    known = materialise(dim.groupBy(F.col(key).alias("_key")).agg(
        F.count("*").alias("_versions"), F.min(changed).alias("_start"), F.max(changed).alias("_end")), "version-spans")
    # a row: what every key's versions last up to the last change of any, through the number of versions
    total = known.agg(
        F.min("_start").alias("start"), F.max("_end").alias("end"), F.sum("_versions").alias("versions"),
        F.sum(F.when(F.col("_start").isNotNull(), 1)).alias("keys"), F.sum(F.col("_start").cast("double")).alias("starts")).collect()[0]
    start, end = total["start"] or 0, total["end"] or 0
    lasting = (total["keys"] or 0) * end - ((total["keys"] or 0) * start if backfill_first else total["starts"] or 0)
    width = max(1, math.ceil(SHARED_BUCKET * lasting / max(1, total["versions"] or 0)))
    shared = (end - start) // width + 1
    met = F.floor((F.col("_end") - F.col("_start")) / F.lit(width)) + 1  # buckets of a key, were it to share them
    own = known.filter(F.col("_versions") > FEW_VERSIONS * met).select(
        "_key", F.col("_versions").alias("_buckets"), "_start", F.greatest(
            F.lit(1), F.ceil((F.col("_end") - F.col("_start")) / F.col("_versions"))).cast("bigint").alias("_width"))
    own = materialise(own, "own-buckets")  # the few hot keys; written, so that facts of one can be split

    def bucket(at: Column) -> Column:
        first, wide = F.coalesce("_start", F.lit(start)), F.coalesce("_width", F.lit(width))
        place = F.floor((_seconds(at) - first) / wide)
        last = F.coalesce("_buckets", F.lit(shared)) - 1
        return F.coalesce(F.least(F.greatest(place, F.lit(0)), last), F.lit(0)).cast("int")

    def spanned(df: DataFrame) -> DataFrame:
        return df.join(own, df[key] == own["_key"], "left")

    held = [c for c in versions.columns]
    facts = spanned(fact).withColumn("_bucket", bucket(F.col(ts))).select(*fact.columns, "_bucket")
    placed = spanned(versions).withColumn("_bucket", F.explode(
        F.sequence(bucket(F.col("_since")), F.greatest(bucket(F.col("_since")), bucket(F.col("_until")))))
    ).select(*held, "_bucket")
    return facts, placed


def pit_join_bucketed(
    fact: DataFrame, dim: DataFrame, key: str, ts: str, closed: str = "both", backfill_first: bool = False, how: str = "inner",
) -> DataFrame:
    """:func:`pit_join` for keys with many versions and many facts: an equi-join on (key, time bucket).

    A fact meets the versions of its own bucket alone, a handful where a key changes evenly over time, so the rows
    compared grow with the facts and not with facts times versions, and a hot key is spread over its buckets. Looks once
    at the versions' times at once, to choose the buckets.
    Same rows as ``pit_join``, and the same ``closed``, ``backfill_first`` and ``how``. Facts with a null time or key meet
    nothing. Times are bucketed by the second; several changes within one are compared in full.
    """
    facts, versions = bucketed_sides(fact, dim, key, ts, backfill_first)
    left, right = facts.alias("fact"), versions.alias("dim")
    same = (F.col(f"fact.{key}") == F.col(f"dim.{key}")) & (F.col("fact._bucket") == F.col("dim._bucket"))
    joined = left.join(right, same & _valid(F.col(f"fact.{ts}"), closed), how)
    return joined.select(*[F.col(f"fact.{c}") for c in fact.columns], *_brought(fact, dim))
