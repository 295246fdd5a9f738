"""SimHash near-duplicates: fingerprints that differ in few bits, found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into four segments of 16 bits. Two fingerprints at 3 or fewer differing bits agree in at
least one segment; the other 48 bits make two words of 24, of which one differs in at most one bit. Every 24-bit word
is decoded to its nearest words of the extended Golay code (one, or six if it lies halfway), and words that differ in
one bit share such a codeword. So (segment, its value, word, codeword) is a key that all linked fingerprints meet in;
the eight ways to choose give some 25 keys each. A pair is reported under the first of its keys only, and the bit
distance is checked in the join.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import map_values
from mercato.llm.components import components
from mercato.session import materialise

SHINGLE, SEED, MOST_BITS = 3, 42, 3
_CHUNK = 1 << 16  # shingles whose bits are counted at a time
_GENERATOR = 0b110001110101  # of the cyclic Golay code of length 23


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint: each bit as in over half of the XXH64 hashes of the word shingles; 0 without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and split at 0x20 and 0x09 to 0x0D
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, np.int64), max(1, len(words) - shingle + 1)
    for at in range(0, total, _CHUNK):
        part = words[at:at + _CHUNK + shingle - 1]
        if len(words) < shingle:
            grams = [tuple(words)]
        else:
            grams = zip(*(part[i:] for i in range(shingle)))
        hashes = np.array([digest(b" ".join(g), SEED) for g in grams], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    return map_values(lambda value: fingerprint(value, shingle), "bigint", text)


def hex16(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of all 12-bit messages; for each syndrome its least error patterns, and how many there are."""
    messages = np.arange(4096, dtype=np.int64)
    remainder = messages << 11
    for bit in range(22, 10, -1):
        remainder ^= np.where(remainder >> bit & 1, _GENERATOR << bit - 11, 0)
    errors = np.array([sum(1 << b for b in c) for n in range(5) for c in combinations(range(24), n)], np.int64)
    weights = np.bitwise_count(errors)
    patterns, counts = np.zeros((4096, 6), np.int64), np.zeros(4096, np.int64)
    for error, weight, at in zip(errors, weights, _syndrome(errors, remainder)):
        if not counts[at] or weight == np.bitwise_count(patterns[at, 0]):
            patterns[at, counts[at]] = error
            counts[at] += 1
    return remainder, patterns, counts


def _syndrome(words: np.ndarray, remainder: np.ndarray) -> np.ndarray:
    """12 bits: parity of the word, and the remainder of its upper 23 bits. Zero for codewords alone."""
    upper = words >> 1
    return (np.bitwise_count(words).astype(np.int64) & 1) << 11 | (upper & 2047) ^ remainder[upper >> 11]


def codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For 24-bit words: (row, 12-bit index of a nearest codeword, whether it is the first of its row)."""
    remainder, patterns, counts = _golay()
    syndrome = _syndrome(words, remainder)
    number = counts[syndrome]
    row = np.repeat(np.arange(len(words)), number)
    place = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    return row, (words[row] ^ patterns[syndrome[row], place]) >> 12, place == 0


def _cut(values: np.ndarray, segment: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The segment's value, and the two 24-bit words that the rest makes."""
    parts = [(values >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    a, b, c = (parts[i] for i in range(4) if i != segment)
    rest = a | b << 16 | c << 32
    return parts[segment], rest & 0xFFFFFF, rest >> 24


def _word_mask(segment: int, word: int) -> int:
    """Signed 64-bit mask of the fingerprint's bits that make the word."""
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
    inside = _cut(bits, segment)[1 + word] != 0
    return int(np.bitwise_or.reduce(bits[inside]).astype(np.int64))


def _keys(batches):
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for segment in range(4):
            exact, *words = _cut(values.view(np.uint64), segment)
            for word in range(2):
                row, code, first = codewords(words[word])
                key = (2 * segment + word) << 28 | exact[row] << 12 | code
                yield pa.record_batch(
                    [pa.array(values[row]), pa.array(key.astype(np.int32)), pa.array(first)], names=["fp", "key", "first"])


def links(fingerprints: DataFrame) -> DataFrame:
    """Pairs (src < dst) of the distinct 64-bit ``fp`` values that differ in 3 or fewer bits, each pair once."""
    keyed = fingerprints.select("fp").mapInArrow(_keys, "fp long, key int, first boolean")
    keyed = materialise(keyed, "simhash-keys")
    a = keyed.select(F.col("fp").alias("src"), "key", "first")
    b = keyed.select(F.col("fp").alias("dst"), F.col("key").alias("key_b"))
    differ = F.col("src").bitwiseXOR(F.col("dst"))
    way = F.shiftright("key", 28)
    once = F.lit(False)
    for segment in range(4):
        earlier = F.lit(True)  # no segment before this one agrees
        for i in range(segment):
            earlier &= F.shiftright(differ, 16 * i).bitwiseAND(F.lit(0xFFFF)) != 0
        for word in range(2):
            here = differ.bitwiseAND(F.lit(_word_mask(segment, word)))
            fits = earlier & (F.bit_count(here) <= 1) & (F.col("first") | (here != 0))
            if word:
                fits &= F.bit_count(differ.bitwiseAND(F.lit(_word_mask(segment, 0)))) > 1
            once |= (way == 2 * segment + word) & fits
    on = (F.col("key") == F.col("key_b")) & (F.col("src") < F.col("dst")) & (F.bit_count(differ) <= MOST_BITS) & once
    return a.join(b, on).select("src", "dst")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(id, text hash, fp) of each row, and (fp, root, smallest id of the root's group)."""
    marked = materialise(
        docs.select(
            F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
            fingerprint_column(F.col(text_col), shingle).alias("fp")),
        "fingerprints")
    distinct = materialise(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    linked = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked, materialise(rooted.drop("least").join(linked, "root"), "fingerprint-groups")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id_col``, fingerprint (16 hex digits) and component_id of every row.

    Rows whose fingerprints differ in at most 3 bits are linked, and component_id is the smallest id reachable over
    links. Texts without a word (null, empty, white space) have fingerprint zero and are linked like any other. Null
    ids take part, but are never a component_id unless a component has no other. Repeated rows are all returned; an
    empty table gives none; no other column is read, whatever its name. Work is on distinct fingerprints: a group of
    equal texts of any size is one of them.
    """
    marked, groups = _grouped(docs, id_col, text_col, shingle)
    return marked.join(groups, "fp").select(
        F.col("id").alias(id_col), hex16(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row of its smallest id stays.

    Where that id is null or repeated within its component, the row of the smallest text hash stays. All columns are kept.
    """
    marked, groups = _grouped(docs, id_col, text_col, shingle)
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    kept = marked.join(groups, "fp").groupBy("root").agg(F.min(place).alias("k")).select(
        F.col("k.id").alias("kept_id"), F.col("k.text_hash").alias("kept_hash"))
    kept = materialise(kept.distinct(), "kept")
    hashed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("its_id"), F.xxhash64(text_col).alias("its_hash"))
    same = hashed["its_id"].eqNullSafe(kept["kept_id"]) & (hashed["its_hash"] == kept["kept_hash"])
    return hashed.join(kept, same, "left_semi").dropDuplicates(["its_id", "its_hash"]).select("row.*")
