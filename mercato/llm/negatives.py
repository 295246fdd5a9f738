"""Hard negatives: for anchors and their nearest rows of the same label, the nearest rows of other labels in a band below.

Rows are dealt at random into blocks of bounded size, coded once (``onebit``) and stored. In a search, each task reads a
block and then the queries as a stream, so a block is sent once however many queries there are, and no more than one
block and one batch of queries is in memory. Intervals from the codes leave few rows, which are scored as integers.
The first search finds the positives; their scores bound the second search, for negatives.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.onebit import LEVELS, Codes, Query, encode
from mercato.llm.vectors import matrix, scaled, usable
from mercato.session import materialise

SCALE = 256
MOST = 1 << 24  # scaled entries stay below this in size, so that sums of products are exact
BLOCK = 8192  # rows that are in memory together
POSITIVES, NEGATIVES = 5, 5
LEAST_PERCENT = 80  # of the positive's score

_BANDS = "array<struct<place:int,id:long,score:long>>"
_POSITIVE = "anchor_row long, anchor_id long, row long, id long, score long"
_NEGATIVE = "anchor_row long, anchor_id long, place int, positive_id long, positive_score long, row long, id long, score long"


@dataclass
class Block:
    rows: np.ndarray
    ids: np.ndarray
    no_id: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    codes: Codes

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places in ``rows`` of the ``k`` highest scores; ties by smaller id, then earlier row, null ids last."""
        return np.lexsort((self.rows[rows], self.ids[rows], self.no_id[rows], -scores))[:k]

    def positives(self, row: int, label: int, vector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the same label that have the ``k`` highest scores in the block, and these."""
        rows = np.flatnonzero((self.labels == label) & (self.rows != row))
        query, estimate = Query(vector), np.zeros(len(rows))
        for level in range(LEVELS):
            if len(rows) <= k:
                break
            estimate, low, high = self.codes.narrow(query, rows, level, estimate)
            stay = high >= np.partition(low, len(low) - k)[len(low) - k]  # k rows reach that for certain
            rows, estimate = rows[stay], estimate[stay]
        scores = self.vectors[rows] @ vector
        first = self.best(rows, scores, k)
        return rows[first], scores[first]

    def negatives(self, label: int, vector: np.ndarray, tops: np.ndarray, k: int, percent: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each positive score, rows of other labels that have the ``k`` highest scores in its band in the block."""
        rows = np.flatnonzero(self.labels != label)
        query, estimate = Query(vector), np.zeros(len(rows))
        bands = [(percent * top / 100, top) for top in np.unique(tops) if top >= 0]  # a negative score's band is empty
        for level in range(LEVELS):
            estimate, low, high = self.codes.narrow(query, rows, level, estimate)
            stay = np.zeros(len(rows), bool)
            for bottom, top in bands:
                inside = low[(low >= bottom) & (high <= top)]
                bar = max(bottom, np.partition(inside, len(inside) - k)[len(inside) - k]) if len(inside) >= k else bottom
                stay |= (high >= bar) & (low <= top)
            rows, estimate = rows[stay], estimate[stay]
        scores = self.vectors[rows] @ vector
        out = []
        for top in tops:
            within = np.flatnonzero((percent * top <= 100 * scores) & (scores <= top))
            first = within[self.best(rows[within], scores[within], k)]
            out.append((rows[first], scores[first]))
        return out


def _block(batches: list[pa.RecordBatch]) -> Block:
    table = pa.Table.from_batches(batches)

    def column(name):
        return table.column(name).combine_chunks()

    vectors = matrix(column("x"))
    alignments = np.array(column("alignments").flatten()).reshape(len(vectors), LEVELS)
    words = np.frombuffer(b"".join(column("words").to_pylist()), "<u8").reshape(len(vectors), LEVELS, -1)
    ids = column("id")
    return Block(
        column("row").to_numpy(), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
        column("label").to_numpy(), vectors, Codes(words, alignments, np.linalg.norm(vectors.astype(float), axis=1)))


def _searched(batches, answer):
    """``answer`` of every query, called with its block: rows come sorted by block, a block's rows before its queries."""
    waiting, block, at = [], None, None
    for batch in batches:
        number, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        key = 2 * number.astype(np.int64) + kind
        edges = np.flatnonzero(np.diff(key)) + 1
        for first, past in zip([0, *edges], [*edges, len(key)]):
            if first == past:
                continue
            part = batch.slice(first, past - first)
            if number[first] != at:
                waiting, block, at = [], None, number[first]
            if kind[first] == 0:
                waiting.append(part)
            elif waiting or block:
                if block is None:
                    block, waiting = _block(waiting), []
                yield from answer(block, part)


def _answers(part: pa.RecordBatch, wide: int):
    names = part.schema.names
    vectors = matrix(part.column(names.index("x")), wide)
    values = (part.column(names.index(n)).to_pylist() for n in ("row", "id", "label", "bands"))
    return zip(*values, vectors)


def _find_positives(k: int):
    def answer(block, part):
        found = [[] for _ in range(5)]
        for row, name, label, _, vector in _answers(part, block.vectors.shape[1]):
            rows, scores = block.positives(row, label, vector, k)
            _extend(found, block, rows, scores, row, name)
        yield _batch(found, _POSITIVE)

    return lambda batches: _searched(batches, answer)


def _find_negatives(k: int, percent: int):
    def answer(block, part):
        found = [[] for _ in range(8)]
        for row, name, label, bands, vector in _answers(part, block.vectors.shape[1]):
            tops = np.array([b["score"] for b in bands], np.int64)
            for band, (rows, scores) in zip(bands, block.negatives(label, vector, tops, k, percent)):
                _extend(found, block, rows, scores, row, name, band["place"], band["id"], band["score"])
        yield _batch(found, _NEGATIVE)

    return lambda batches: _searched(batches, answer)


def _extend(found: list[list], block: Block, rows: np.ndarray, scores: np.ndarray, *fixed) -> None:
    ids = [None if no else i for i, no in zip(block.ids[rows].tolist(), block.no_id[rows])]
    values = [[value] * len(rows) for value in fixed] + [block.rows[rows].tolist(), ids, scores.tolist()]
    for column, more in zip(found, values, strict=True):
        column.extend(more)


def _batch(columns: list[list], kind: str) -> pa.RecordBatch:
    fields = [f.rsplit(" ", 1) for f in kind.split(", ")]
    return pa.record_batch(
        [pa.array(c, pa.int32() if t == "int" else pa.int64()) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def _coded(rows: DataFrame, wide: int) -> DataFrame:
    """Rows (row, id, label, x) with their code words and alignments."""
    def code(batches):
        for batch in batches:
            words, alignments = encode(matrix(batch.column(3), wide).astype(float))
            vectors = matrix(batch.column(3), wide)
            yield pa.record_batch([
                *batch.columns[:3], pa.array(vectors.tolist(), pa.list_(pa.int64())),
                pa.array([w.tobytes() for w in words], pa.binary()), pa.array(alignments.tolist(), pa.list_(pa.float64()))],
                names=["row", "id", "label", "x", "words", "alignments"])

    return rows.mapInArrow(code, "row long, id long, label long, x array<long>, words binary, alignments array<double>")


def _search(index: DataFrame, queries: DataFrame, blocks: int, find, kind: str) -> DataFrame:
    """What ``find`` yields for each block of ``index`` and all of ``queries`` (row, id, label, x, bands)."""
    columns = ["row", "id", "label", "x", "words", "alignments", "bands"]
    held = index.withColumn("bands", F.lit(None).cast(_BANDS)).select(
        F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), *columns)
    asked = queries.withColumns({
        "words": F.lit(None).cast("binary"), "alignments": F.lit(None).cast("array<double>"),
        "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))}).select("block", F.lit(1).alias("kind"), *columns)
    met = held.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "kind", "row")
    return met.mapInArrow(find, kind)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, least_percent: int = LEAST_PERCENT, scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows where ``is_anchor`` holds. A score is the inner product of vectors whose entries became
    floor(scale * x). An anchor's positives are the ``positives`` other rows of its label with the highest scores, and for
    each of them the negatives are the ``negatives`` rows of other labels with the highest scores among those of at
    least ``least_percent`` percent of the positive's score and at most that score; a positive with a negative score has
    none. Ties go to the smaller id, null ids last, then to the earlier row; fewer are all returned.

    Rows with a null label, a null vector, or a null or non-finite entry take no part; rows with a null id do, though a
    null ``is_anchor`` is no anchor. Repeated rows are rows of their own, as anchors, positives and negatives. A shorter
    vector counts as filled up with zeros. Scaled entries of ``MOST`` or more raise. An empty table, or one without
    anchors, gives no rows. Other columns are not read but by ``is_anchor`` and ``label``, whatever their names.
    """
    given = rows.select(
        F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vector_col).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    given = given.filter(usable(F.col("vector")) & F.col("label").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), "id", "label", scaled(F.col("vector"), scale, MOST).alias("x"), "asks")
    given = materialise(given, "vectors")
    count, wide = given.agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(0))).collect()[0]
    blocks = max(1, -(-count // BLOCK))
    index = materialise(_coded(given.drop("asks"), wide), "coded-vectors")
    asked = given.filter("asks").select("row", "id", "label", "x")

    near = _search(index, asked.withColumn("bands", F.array().cast(_BANDS)), blocks, _find_positives(positives), _POSITIVE)
    near = _ranked(near, ["anchor_row"], positives, "place")
    bands = near.groupBy("anchor_row").agg(F.collect_list(F.struct("place", "id", "score")).cast(_BANDS).alias("bands"))
    asked = materialise(asked.join(bands, asked["row"] == bands["anchor_row"]).drop("anchor_row"), "anchors")
    far = _search(index, asked, blocks, _find_negatives(negatives, least_percent), _NEGATIVE)
    return _ranked(far, ["anchor_row", "place"], negatives, "rank").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _ranked(found: DataFrame, by: list[str], most: int, name: str) -> DataFrame:
    """The best of what the blocks found: ``most`` a block at most, so a query's share grows with the blocks alone."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return found.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= most)
