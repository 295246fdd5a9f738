"""Benchmark decontamination: word n-grams as seeds, then Smith-Waterman alignment.

The seeds of a test item are all its n-grams. A bitmap of fixed size holds their hashes; each task
looks the n-grams of its texts up in it and keeps only the passages around hits. These meet the items in an equi-join
on the seed. Every pair of an item and a different passage that shares a seed is aligned word by word, so that edited
and paraphrased copies score by what they kept, and the scores go back to all copies of the passage.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from mercato.llm.common import map_values
from mercato.llm.words import blocks, split_words
from mercato.session import materialise

GRAM = 3  # words of a seed
BITMAP_BITS = 24  # the bitmap has 2**24 bits (2 MB), whatever the number of items
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5  # of the score of an identical passage


def alignment_score(item: np.ndarray, passage: np.ndarray) -> float:
    """Best local alignment of two sequences of word hashes, as a share of the score of ``item`` with itself."""
    if not len(item) or not len(passage):
        return 0.0
    place = np.arange(len(passage)) * -GAP
    row, best = np.zeros(len(passage) + 1, np.int64), 0
    for word in item:
        here = np.maximum(row[:-1] + np.where(passage == word, MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(here, 0, out=here)
        row[1:] = np.maximum.accumulate(here + place) - place  # gaps along the passage
        best = max(best, int(row.max()))
    return best / (MATCH * len(item))


def _reach(n_words: int, least_score: float) -> int:
    """Words that an alignment of such a score can have in the passage: what its matches leave for gaps is bounded."""
    return math.ceil((MATCH + 1 - MATCH * least_score) * n_words)


def copy_score(item: str, passage: str, least_score: float) -> float:
    """:func:`alignment_score` of two texts where it can reach ``least_score``, else zero.

    A score is at most the share of the item's words, each as often as it stands there, that the passage holds; so most
    pairs that share a seed need no alignment.
    """
    words, within = (split_words([text.encode()], unspaced=True).hashes for text in (item, passage))
    kinds, often = np.unique(words, return_counts=True)
    held, held_often = np.unique(within[np.isin(within, kinds)], return_counts=True)
    if np.minimum(held_often, often[np.searchsorted(kinds, held)]).sum() < least_score * len(words):
        return 0.0
    return alignment_score(words, within)


def _grams(text: str | None) -> tuple[list[int], int]:
    words = split_words([(text or "").encode()], unspaced=True)
    return np.unique(words.grams(GRAM)[0]).view(np.int64).tolist(), len(words.hashes)


def _items(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Different texts of the items: item (a number), item_ids, item_text, grams, n_words."""
    distinct = items.filter(F.col(text_col).isNotNull()).groupBy(F.col(text_col).alias("item_text")).agg(
        F.collect_set(item_col).alias("item_ids"))
    cut = map_values(_grams, "struct<grams:array<long>,n_words:int>", F.col("item_text"))
    return materialise(
        distinct.withColumn("c", cut).select(
            F.monotonically_increasing_id().alias("item"), "item_ids", "item_text", "c.*"), "items")


def _seeds(items: DataFrame) -> DataFrame:
    """(item, seed): all n-grams of the items."""
    return materialise(items.select("item", F.explode("grams").alias("seed")), "seeds")


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """Bits of the seeds' hashes. Its words, 2**18 at most, are all that comes to the driver."""
    words = (
        seeds.select((F.col("seed").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")))
    out = np.zeros(1 << BITMAP_BITS - 6, np.int64)
    for row in words.collect():
        out[row["word"]] = row["bits"]
    return out.view(np.uint64)


def _passages(docs: DataFrame, bitmap, reach: int) -> DataFrame:
    """Stretches of ``reach`` words around n-grams that the bitmap may hold: id, row, passage, hits."""
    fields = [docs.schema["id"], docs.schema["row"], StructField("passage", StringType()), StructField("hits", ArrayType(LongType()))]

    def find(batches):
        bits = bitmap.value
        for batch in batches:
            rows, passages, hits = [], [], []
            done = 0
            for words in blocks((text.as_py() for text in batch.column(2)), unspaced=True):
                grams, first = words.grams(GRAM)
                bit = grams & np.uint64((1 << BITMAP_BITS) - 1)
                hit = np.flatnonzero(bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1))
                if len(hit):
                    place, text = first[hit], words.text[first[hit]]
                    cut = np.flatnonzero((np.diff(place) > reach) | (np.diff(text) > 0)) + 1
                    lows = np.searchsorted(words.text, np.arange(words.texts))
                    highs = np.searchsorted(words.text, np.arange(words.texts), side="right")
                    for part in np.split(np.arange(len(hit)), cut):
                        number = text[part[0]]
                        a = max(place[part[0]] - reach, lows[number])
                        b = min(place[part[-1]] + GRAM + reach, highs[number]) - 1
                        rows.append(done + int(number))
                        passages.append(words.block[words.starts[a]:words.ends[b]].decode())
                        hits.append(np.unique(grams[hit[part]]).view(np.int64).tolist())
                done += words.texts
            taken = pa.array(rows, pa.int32())
            yield pa.record_batch(
                [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(passages, pa.string()),
                 pa.array(hits, pa.list_(pa.int64()))], names=[f.name for f in fields])

    return docs.mapInArrow(find, StructType(fields))


def find_contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", least_score: float = LEAST_SCORE,
) -> DataFrame:
    """``id_col``, text_hash, ``item_col``, score: each row of ``docs`` with each item it holds a copy of.

    Words are runs of letters and digits, A-Z lowered, and single characters of scripts without spaces. ``score`` is the best local alignment of the item with a passage,
    as a share of an identical one's, at least ``least_score``. Null and empty texts and items of fewer than three words
    match nothing. Items of equal text match alike; repeated rows of ``docs`` give their pairs once each. Empty tables
    give none, and no other column is read.
    """
    spark = docs.sparkSession
    known = _items(items, item_col, item_text_col)
    longest = known.agg(F.coalesce(F.max("n_words"), F.lit(0))).collect()[0][0]
    seeds = _seeds(known)
    bitmap = spark.sparkContext.broadcast(_bitmap(seeds))
    named = docs.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row_number"), F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("text_hash"))
    passages = _passages(
        named.select("id", F.struct("row_number", "text_hash").alias("row"), "text"), bitmap,
        _reach(max(longest, GRAM), least_score))
    passages = materialise(passages.withColumn("digest", F.sha2("passage", 256)), "passages")
    # equal passages are looked at once: a seed costs as much as it has different surroundings, however many copies
    hits = materialise(passages.select("digest", F.explode("hits").alias("seed")).distinct(), "hits")
    pairs = materialise(hits.join(seeds, "seed").select("digest", "item").distinct(), "pairs")
    different = materialise(passages.groupBy("digest").agg(F.first("passage").alias("passage")), "different-passages")
    texts = pairs.join(different, "digest").join(known.select("item", "item_text"), "item")

    def score(item, passage):
        return copy_score(item, passage, least_score)

    scores = materialise(
        texts.withColumn("score", map_values(score, "double", F.col("item_text"), F.col("passage")))
        .filter(F.col("score") >= least_score).select("digest", "item", "score"), "scores")
    best = (
        passages.select("digest", "id", "row").join(scores, "digest")
        .groupBy("id", "row", "item").agg(F.max("score").alias("score")))
    return (
        best.join(known.select("item", "item_ids"), "item")
        .select(F.col("id").alias(id_col), F.col("row.text_hash").alias("text_hash"), F.explode("item_ids").alias(item_col), "score"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no copy of an item, with all their columns.

    Null, empty and very long texts, repeated rows and empty tables are taken as :func:`find_contamination` takes them:
    rows without words stay, all copies of a row stay or go together, and no items drop nothing.
    """
    found = find_contamination(docs, items, id_col, text_col)
    found = materialise(found.select(F.col(id_col).alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct(), "contaminated")
    same = docs[id_col].eqNullSafe(found["hit_id"]) & (F.xxhash64(docs[text_col]) == found["hit_hash"])
    return docs.join(found, same, "left_anti")
