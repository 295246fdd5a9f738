"""Global NTILE without a single-partition sort."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from mercato.session import Scratch

_INDEX_BITS = 33  # monotonically_increasing_id: partition number above, row index within it below
SAMPLE_ROWS = 20_000  # proposes where to look; exact counts confirm or refuse that, so it drops nothing

Place = tuple  # (value or None, tie-break)


@dataclass
class _Span:
    """A stretch of one score's order, known to hold the rows of the given ranks."""

    score: int
    ranks: list[int]
    low: Place | None = None
    high: Place | None = None
    below: int = 0  # rows before the stretch
    found: dict[int, Place] = field(default_factory=dict)


@dataclass(frozen=True)
class _Order:
    """Ascending order over (value, tie-break): structs compare field by field, NULL values first."""

    place: Column
    value_type: DataType

    def literal(self, place: Place) -> Column:
        value, tie = place
        return F.struct(F.lit(value).cast(self.value_type).alias("value"), F.lit(tie).alias("tie"))

    def after(self, place: Place) -> Column:
        return self.place > self.literal(place)

    def before(self, place: Place) -> Column:
        return self.place < self.literal(place)

    def within(self, span: _Span) -> Column:
        low = F.lit(True) if span.low is None else self.place >= self.literal(span.low)
        high = F.lit(True) if span.high is None else self.place <= self.literal(span.high)
        return low & high


def global_ntile(
    df: DataFrame,
    buckets: int,
    scores: dict[str, str],
    tie_break: str,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Add one NTILE column per entry of ``scores`` (new column -> ascending order column).

    Equal to ``ntile(buckets)`` over the whole table ordered by the column, NULLs first, then ``tie_break``
    (unique, not NULL). Only the last row of each bucket has to be found; every score is then a comparison
    with those few rows, so ``df`` itself is neither sorted, shuffled nor joined.

    A sample proposes a narrow stretch around each wanted row, an exact count confirms that the row lies in it,
    and only the stretch is sorted; a stretch that does not hold is replaced by the whole order. Sorting is by range over all tasks
    and includes the tie-break, so a value shared by most rows still splits evenly. ``df`` is read several
    times and should be a table. Order columns must share one type.
    """
    types = {df.schema[c].dataType for c in scores.values()}
    if len(types) != 1:
        raise TypeError(f"order columns differ in type: {types}")
    (value_type,) = types
    orders = [
        _Order(F.struct(F.col(c).alias("value"), F.col(tie_break).alias("tie")), value_type) for c in scores.values()]

    total = df.count()
    ranks = sorted({r for r in _last_ranks(total, buckets) if 0 < r < total})
    if not ranks:
        return df.withColumns({name: F.lit(1) for name in scores})
    spans = _narrowed(df, orders, total, ranks, sample_rows)
    with Scratch(df.sparkSession) as scratch:
        _find(df, orders, spans, scratch)

    tiles = {}
    for i, name in enumerate(scores):
        edges = {rank: place for span in spans if span.score == i for rank, place in span.found.items()}
        passed = [orders[i].after(edges[rank]).cast("int") for rank in ranks]
        tiles[name] = reduce(lambda a, b: a + b, passed, F.lit(1))
    return df.withColumns(tiles)


def _last_ranks(total: int, buckets: int) -> list[int]:
    """Rank of the last row of every bucket but the final one; the first buckets take the extra rows."""
    size, extra = divmod(total, buckets)
    return [b * size + min(b, extra) for b in range(1, buckets)]


def _narrowed(df: DataFrame, orders: list[_Order], total: int, ranks: list[int], sample_rows: int) -> list[_Span]:
    """One stretch per score and rank, proposed by a sample and confirmed by exact counts."""
    columns = [o.place.alias(f"s{i}") for i, o in enumerate(orders)]
    sample = df.select(*columns).sample(min(1.0, sample_rows / total), seed=1).collect()
    size = len(sample)
    margin = 2 * isqrt(size) + 1  # four standard deviations of a sampled rank
    spans = []
    for i in range(len(orders)):
        places = sorted(
            ((row[i]["value"], row[i]["tie"]) for row in sample),
            key=lambda p: (p[0] is not None, 0 if p[0] is None else p[0], p[1]))
        for rank in ranks:
            middle = rank * size // total
            low, high = middle - margin, middle + margin
            spans.append(_Span(i, [rank], places[low] if low >= 0 else None, places[high] if high < size else None))

    counts = []
    for j, span in enumerate(spans):
        order = orders[span.score]
        below = F.lit(False) if span.low is None else order.before(span.low)
        upto = F.lit(True) if span.high is None else ~order.after(span.high)
        counts += [F.count_if(below).alias(f"below{j}"), F.count_if(upto).alias(f"upto{j}")]
    counted = df.agg(*counts).collect()[0]

    confirmed, missed = [], {}
    for j, span in enumerate(spans):
        span.below = counted[f"below{j}"]
        if span.below < span.ranks[0] <= counted[f"upto{j}"]:
            confirmed.append(span)
        else:
            missed.setdefault(span.score, []).extend(span.ranks)
    return confirmed + [_Span(score, lost) for score, lost in missed.items()]


def _find(df: DataFrame, orders: list[_Order], spans: list[_Span], scratch: Scratch) -> None:
    """Sort the rows of each span and look its ranks up by position."""
    rows = [
        F.when(orders[s.score].within(s), F.struct(F.lit(j).alias("span"), orders[s.score].place.alias("place")))
        for j, s in enumerate(spans)
    ]
    by = ["span", "value", "tie"]
    placed = (
        df.select(F.explode(F.array(*rows)).alias("row")).filter("row IS NOT NULL")
        .select("row.span", "row.place.value", "row.place.tie")
        .repartitionByRange(*by).sortWithinPartitions(*by)
        .withColumn("position", F.monotonically_increasing_id())
    )
    # range bounds come from sampling, so positions must be settled before two jobs use them
    placed = scratch.materialise(placed, "ntile")
    runs = (
        placed.groupBy("span", F.shiftright("position", _INDEX_BITS).alias("part"))
        .agg(F.count("*").alias("rows"), F.min("position").alias("start"))
        .orderBy("span", "part").collect()  # one row per span and task
    )
    wanted: dict[int, tuple[_Span, int]] = {}
    for j, span in enumerate(spans):
        own = [r for r in runs if r["span"] == j]
        for rank in span.ranks:
            wanted[_position(own, rank - span.below)] = (span, rank)
    for row in placed.filter(F.col("position").isin(list(wanted))).collect():
        span, rank = wanted[row["position"]]
        span.found[rank] = (row["value"], row["tie"])


def _position(runs: list, rank: int) -> int:
    """Position of the row with the given 1-based rank."""
    before = 0
    for run in runs:
        if rank <= before + run["rows"]:
            return run["start"] + rank - before - 1
        before += run["rows"]
    raise LookupError(f"rank {rank} is past the {before} rows of its span")
