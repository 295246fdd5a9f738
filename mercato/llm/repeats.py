"""Long repeats: every byte covered by a string of 400 bytes that also starts elsewhere.

Equal windows meet in one task because each window of 400 bytes picks the least hash among its own stretches of 128
bytes, its anchor; equal windows pick equal anchors. A run of windows with one anchor makes a context. Contexts whose
anchor occurs once are done. Equal contexts become one with a count. What is left meets by anchor, some megabytes at
a time, and there the Burrows-Wheeler transform of the contexts is searched breadth first: intervals of one sign are
extended backward, which yields the common prefixes of neighbouring suffixes by increasing length, and the search
stops at 400. Rows whose common prefix is not known by then are repeats.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from mercato.llm.common import map_values
from mercato.llm.rolling import mix, powers, prefix_sums
from mercato.session import materialise

LENGTH, ANCHOR = 400, 128
CHUNK = 1 << 22  # windows of a text that are looked at together
SORTED_BYTES = 1 << 20  # contexts are transformed so many bytes at a time
MOST_KINDS = 1500  # different contexts of an anchor that are transformed together; beyond, windows are counted one by one
_UNKNOWN = np.uint16(0xFFFF)


# contexts

def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    least, span = values, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    count = len(values) - width + 1
    return np.minimum(least[:count], least[width - span:width - span + count])


def _runs(picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(picked[1:] != picked[:-1]) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(picked)]])


def contexts(text: bytes, length: int = LENGTH, anchor: int = ANCHOR):
    """(anchor hash, first window, past the last window) of each run of windows that pick the same anchor."""
    for at in range(0, len(text) - length + 1, CHUNK):
        part = text[at:at + CHUNK + length - 1]
        sums = prefix_sums(np.frombuffer(part, np.uint8))
        grams = len(part) - anchor + 1
        hashes = mix((sums[anchor:] - sums[:-anchor]) * powers(len(sums))[1][:grams])
        place = np.arange(grams, dtype=np.uint64)
        picked = _sliding_least(hashes >> np.uint64(24) << np.uint64(24) | place, length - anchor + 1) & np.uint64(0xFFFFFF)
        first, past = _runs(picked)
        signed = hashes[picked[first]].view(np.int64)
        yield from zip(signed.tolist(), (first + at).tolist(), (past + at).tolist())


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


# the transform

def suffix_order(signs: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, sorted by their first ``depth`` signs (or more) by prefix doubling."""
    count = len(signs)
    padded = np.zeros(count + 8, np.uint64)
    padded[:count] = signs
    key = np.zeros(count, np.uint64)
    for i in range(7):  # signs go up to 256, so nine bits each
        key = key << np.uint64(9) | padded[i:i + count]
    order = np.argsort(key)
    ranked = key[order]
    fresh = np.ones(count, bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    known = 7
    rank = np.zeros(count + 1, np.int64)  # a suffix past the end ranks lowest
    head = np.maximum.accumulate(np.where(fresh, np.arange(count), 0))
    rank[order] = head + 1
    while known < depth:
        alone = fresh.copy()
        alone[:-1] &= fresh[1:]
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
        starts = order[tied]
        key = rank[starts] << 32 | rank[np.minimum(starts + known, count)]
        by = np.argsort(key)
        key = key[by]
        starts = starts[by]
        order[tied] = starts
        differs = np.ones(len(tied), bool)
        differs[1:] = key[1:] != key[:-1]
        fresh[tied] = differs
        rank[starts] = np.maximum.accumulate(np.where(differs, tied, 0)) + 1
        known *= 2
    return order


def repeated_starts(signs: np.ndarray, length: int) -> np.ndarray:
    """For each start in ``signs`` (0 separates texts, 1 to 256 are bytes) whether its next ``length`` signs also start
    elsewhere; right where these hold no separator.

    ``common[r]`` is the common prefix of the suffixes of rows r - 1 and r. An interval holds the rows that begin with
    one string w. Extending w backward by each sign c before its rows gives the interval of cw; if the boundary at its
    end was unknown, its value is the length of w, as all shorter values have been set before.
    """
    count = len(signs)
    order = suffix_order(signs, length)
    before = signs[order - 1]  # the transform; row of start 0 wraps to the last sign, a separator
    by_sign = np.argsort(before, kind="stable")
    step = np.empty(count, np.int64)  # the row of the suffix that is one sign longer
    step[by_sign] = np.arange(count)
    sorted_signs = before[by_sign]
    same = sorted_signs[1:] == sorted_signs[:-1]
    following = np.full(count, count)
    following[by_sign[:-1][same]] = by_sign[1:][same]
    preceding = np.full(count, -1)
    preceding[by_sign[1:][same]] = by_sign[:-1][same]
    usable = before > 0

    common = np.full(count + 1, _UNKNOWN)
    common[0] = common[count] = 0
    low, high = np.zeros(1, np.int64), np.full(1, count)
    for value in range(length):
        size = high - low
        total = int(size.sum())
        if not total:
            break
        rows = np.arange(total) + np.repeat(low - np.cumsum(size) + size, size)
        fits = usable[rows] | (value == 0)  # separators end strings, and never stand within one
        last = step[rows[fits & (following[rows] >= np.repeat(high, size))]]
        first = step[rows[fits & (preceding[rows] < np.repeat(low, size))]]
        last.sort()
        first.sort()
        new = common[last + 1] == _UNKNOWN
        low, high = first[new], last[new] + 1
        common[high] = value
    shared = common == _UNKNOWN
    out = np.zeros(count, bool)
    out[order] = shared[:-1] | shared[1:]
    return out


def _spans(flags: np.ndarray) -> list[int]:
    """Start and end of each run of set flags, one after the other."""
    edges = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edges).tolist()


def _settle(group: list[tuple], length: int):
    """(anchor, context, runs of repeated windows) of contexts (anchor, context, count, bytes)."""
    signs = np.zeros(sum(len(g[3]) + 1 for g in group), np.uint16)
    at, places = 0, []
    for _, _, _, text in group:
        places.append(at)
        signs[at:at + len(text)] = np.frombuffer(text, np.uint8)
        signs[at:at + len(text)] += 1
        at += len(text) + 1
    repeated = repeated_starts(signs, length)
    for (anchor, context, number, text), at in zip(group, places):
        windows = len(text) - length + 1
        runs = [0, windows] if number > 1 else _spans(repeated[at:at + windows])
        if runs:
            yield anchor, context, runs


# the job

_SETTLED = "anchor long, context long, runs array<int>"


def _settled_batch(rows: list[tuple]) -> pa.RecordBatch:
    anchors, names, runs = zip(*rows) if rows else ((), (), ())
    return pa.record_batch(
        [pa.array(anchors, pa.int64()), pa.array(names, pa.int64()), pa.array(runs, pa.list_(pa.int32()))],
        names=["anchor", "context", "runs"])


def _found(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """One row per context: id, text_hash, anchor, context (hash of its bytes), first window, number of windows."""
    fields = [docs.schema["id"], docs.schema["text_hash"]]
    out = StructType(fields + [StructField(n, LongType()) for n in ("anchor", "context", "first", "windows")])

    def find(batches):
        for batch in batches:
            rows, values = [], [[], [], [], []]
            for number, text in enumerate(batch.column(2)):
                text = (text.as_py() or "").encode()
                for hashed, first, past in contexts(text, length, anchor):
                    rows.append(number)
                    name = xxhash.xxh3_64_intdigest(text[first:past + length - 1])
                    for column, value in zip(values, (hashed, _signed(name), first, past - first)):
                        column.append(value)
            taken = pa.array(rows, pa.int32())
            yield pa.record_batch(
                [batch.column(0).take(taken), batch.column(1).take(taken), *(pa.array(v, pa.int64()) for v in values)],
                names=out.names)

    return docs.mapInArrow(find, out)


def _fetched(kinds: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """``kinds`` with the bytes of each context, read from the text that holds its first place."""
    wanted = kinds.groupBy("at.id", "at.text_hash").agg(
        F.collect_list(F.struct("anchor", "context", "number", F.col("at.first").alias("first"), "windows")).alias("wanted"))
    wanted = wanted.toDF("wanted_id", "wanted_hash", "wanted")
    same = docs["id"].eqNullSafe(wanted["wanted_id"]) & (docs["text_hash"] == wanted["wanted_hash"])
    cut = map_values(
        lambda text, wanted: [
            {**w, "text": text[w.pop("first"):][:w.pop("windows") + length - 1]}
            for text in [(text or "").encode()] for w in wanted],
        "array<struct<anchor:long,context:long,number:long,text:binary>>", F.col("text"), F.col("wanted"))
    return docs.join(wanted, same).select(F.explode(cut).alias("c")).select("c.*")


def _settle_by_transform(fetched: DataFrame, length: int) -> DataFrame:
    def settle(batches):
        group, size, seen, last = [], 0, set(), None
        for batch in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != last:
                    if size >= SORTED_BYTES:
                        rows += _settle(group, length)
                        group, size = [], 0
                    seen, last = set(), row[0]
                if row[1] not in seen:  # a repeated row of documents gives its contexts again
                    seen.add(row[1])
                    group.append(row)
                    size += len(row[3])
            yield _settled_batch(rows)
        if group:
            yield _settled_batch(list(_settle(group, length)))

    return fetched.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(settle, _SETTLED)


def _settle_by_counts(fetched: DataFrame, length: int) -> DataFrame:
    """For anchors that very many different texts share: count every window by its hash, map side first."""
    def windows(batches):
        for batch in batches:
            for anchor, context, number, text in zip(*(c.to_pylist() for c in batch.columns)):
                count = len(text) - length + 1
                hashes = [_signed(xxhash.xxh3_64_intdigest(text[i:i + length])) for i in range(count)]
                yield pa.record_batch(
                    [pa.array([anchor] * count, pa.int64()), pa.array([context] * count, pa.int64()),
                     pa.array([number] * count, pa.int64()), pa.array(range(count), pa.int32()), pa.array(hashes, pa.int64())],
                    names=["anchor", "context", "number", "start", "hash"])

    each = fetched.dropDuplicates(["anchor", "context"]).mapInArrow(
        windows, "anchor long, context long, number long, start int, hash long")
    each = materialise(each, "windows")
    often = each.groupBy("anchor", "hash").agg(F.sum("number").alias("all")).filter("all > 1").select("anchor", "hash")
    often = materialise(often, "repeated-windows")

    def joined(starts):
        flags = np.zeros(max(starts) + 1, bool)
        flags[starts] = True
        return _spans(flags)

    return (
        each.join(often, ["anchor", "hash"]).groupBy("anchor", "context").agg(F.collect_list("start").alias("starts"))
        .select("anchor", "context", map_values(joined, "array<int>", F.col("starts")).alias("runs")))


def _cut(text: str | None, runs: list[int] | None, length: int) -> tuple:
    raw = (text or "").encode()
    covered = np.zeros(len(raw) + 1, np.int64)
    for first, past in zip(runs[::2], runs[1::2]) if runs else ():
        covered[first] += 1
        covered[min(past + length - 1, len(raw))] -= 1
    gone = np.cumsum(covered[:-1]) > 0
    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if runs else raw
    spans = _spans(gone) if runs else []
    return len(raw), len(raw) - len(kept), len(spans) // 2, kept, spans


def _with_runs(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """``docs`` (id, text_hash, text) with ``runs``: start and end of each run of repeated windows."""
    found = materialise(_found(docs, length, anchor), "contexts")
    often = found.groupBy("anchor").agg(F.count("*").alias("places")).filter("places > 1").select("anchor")
    # written before the join, so that an anchor that a large part of all texts holds can be split in it
    found = materialise(found.join(materialise(often, "shared-anchors"), "anchor"), "shared-contexts")
    kinds = found.groupBy("anchor", "context").agg(
        F.count("*").alias("number"), F.min(F.struct("id", "text_hash", "first")).alias("at"), F.first("windows").alias("windows"))
    kinds = materialise(kinds, "context-kinds")
    per_anchor = materialise(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")), "anchors")
    kinds = kinds.join(per_anchor, "anchor")
    # one kind of context, in several places: all its windows are repeats, and no other context can hold them
    whole = kinds.filter("kinds = 1").select("anchor", "context", F.array(F.lit(0), F.col("windows").cast("int")).alias("runs"))
    several = materialise(_fetched(kinds.filter("kinds > 1"), docs, length).join(per_anchor, "anchor"), "context-texts")
    columns = ["anchor", "context", "number", "text"]
    settled = whole.union(_settle_by_transform(several.filter(F.col("kinds") <= MOST_KINDS).select(columns), length))
    if per_anchor.filter(F.col("kinds") > MOST_KINDS).limit(1).count():
        settled = settled.union(_settle_by_counts(several.filter(F.col("kinds") > MOST_KINDS).select(columns), length))
    settled = materialise(settled, "settled")
    shifted = F.transform("runs", lambda x: x + F.col("first"))
    runs = (
        found.select("id", "text_hash", "anchor", "context", "first").distinct().join(settled, ["anchor", "context"])
        .groupBy("id", "text_hash").agg(F.flatten(F.collect_list(shifted)).alias("runs"))
        .toDF("runs_id", "runs_hash", "runs"))
    same = docs["id"].eqNullSafe(runs["runs_id"]) & (docs["text_hash"] == runs["runs_hash"])
    return docs.join(runs, same, "left").select("id", "text_hash", "text", "runs")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR,
) -> DataFrame:
    """``id_col``, n_bytes, n_removed, n_spans, kept (binary) and spans (start and end of each removed run, in bytes).

    A byte of a text's UTF-8 goes if a string of ``length`` bytes that covers it also starts anywhere else, in the same
    document or another; matches never cross documents, and strings are judged on the input. Null texts are empty, and
    texts shorter than ``length`` lose nothing. Repeated rows, also with equal or null ids, are documents of their own,
    so their texts lose everything if long enough. An empty table gives no rows; no other column is read.
    """
    named = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    cut = map_values(
        lambda text, runs: _cut(text, runs, length),
        "struct<n_bytes:long,n_removed:long,n_spans:long,kept:binary,spans:array<int>>", F.col("text"), F.col("runs"))
    return _with_runs(named, length, anchor).select(F.col("id").alias(id_col), cut.alias("cut")).select(id_col, "cut.*")
