"""Byte-level BPE: encoding by merge ranks with a segment tree, and decoding.

A piece is one match of the splitting pattern. Over its byte positions stands a segment tree whose root is the
leftmost pair of least rank; a merge changes three leaves (the merged part, the part it swallowed, and the live
neighbour to the left), each a walk of logarithmic length to the root. A piece of n bytes takes O(n log n), so
a text without any white space is as safe as prose. Pieces of a word's length need no tree.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import driver_file, map_values

_NO_PAIR = 1 << 62
SHORT_PIECE = 48  # bytes, up to which looking through all pairs is faster than the tree
KEPT_PIECES = 1 << 17  # of up to 32 bytes, whose tokens a worker remembers; those not asked for since then are forgotten


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Lines of base64 bytes and their rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """:func:`merge_piece` by looking through all pairs at each merge, which is quadratic, but faster for few bytes."""
    parts = [piece[at:at + 1] for at in range(len(piece))]
    rank_of = ranks.get
    pairs = [rank_of(piece[at:at + 2], _NO_PAIR) for at in range(len(piece) - 1)]
    while pairs and (best := min(pairs)) != _NO_PAIR:
        at = pairs.index(best)
        merged = parts[at] = parts[at] + parts[at + 1]
        del parts[at + 1], pairs[at]
        if at < len(pairs):
            pairs[at] = rank_of(merged + parts[at + 1], _NO_PAIR)
        if at:
            pairs[at - 1] = rank_of(parts[at - 1] + merged, _NO_PAIR)
    return [ranks[part] for part in parts]


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece: always merge the leftmost pair of least rank."""
    count = len(piece)
    if count <= SHORT_PIECE:
        return merge_short(piece, ranks)
    width = 1 << (count - 1).bit_length()
    last = width - 1
    after = list(range(1, count + 1))  # where the part that starts here ends
    before = list(range(-1, count - 1))  # where the part to the left starts
    # a node holds rank * width + position, so the least node is the leftmost of least rank
    tree = [_NO_PAIR] * (2 * width)
    rank_of = ranks.get
    for at in range(count - 1):
        rank = rank_of(piece[at:at + 2])
        if rank is not None:
            tree[width + at] = rank * width + at
    for node in range(width - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right

    def put(at: int, value: int) -> None:
        node = width + at
        tree[node] = value
        while node > 1:
            other = tree[node ^ 1]
            node >>= 1
            least = value if value < other else other
            if tree[node] == least:
                return
            tree[node] = value = least

    def pair(at: int) -> int:
        middle = after[at]
        if middle >= count:
            return _NO_PAIR
        rank = rank_of(piece[at:after[middle]])
        return _NO_PAIR if rank is None else rank * width + at

    while (best := tree[1]) != _NO_PAIR:
        at = best & last
        swallowed = after[at]
        end = after[at] = after[swallowed]
        if end < count:
            before[end] = at
        put(swallowed, _NO_PAIR)
        put(at, pair(at))
        if (left := before[at]) >= 0:
            put(left, pair(left))
    ids, at = [], 0
    while at < count:
        ids.append(ranks[piece[at:after[at]]])
        at = after[at]
    return ids


class _Pieces(dict):
    """Piece -> its ids as little-endian 32-bit integers, worked out when first asked for."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece) or self._encoded(piece.encode())
        if len(self) >= KEPT_PIECES:
            self.older = dict(self)
            self.clear()
        if len(piece) <= 32:
            self[piece] = packed
        return packed

    def _encoded(self, raw: bytes) -> bytes:
        whole = self.ranks.get(raw)
        ids = merge_piece(raw, self.ranks) if whole is None else [whole]
        return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def _encoder(raw: bytes, pattern: str):
    import regex

    pieces = _Pieces(read_ranks(raw))
    return regex.compile(pattern).findall, pieces.__getitem__


@lru_cache(maxsize=2)
def _vocabulary(raw: bytes):
    tokens = {rank: token for token, rank in read_ranks(raw).items()}
    return tokens.__getitem__


def _encode(raw: bytes, pattern: str, text: str | None) -> bytes:
    split, tokens = _encoder(raw, pattern)
    return b"".join(map(tokens, split(text))) if text else b""


def _decode(raw: bytes, ids: bytes | None) -> bytes:
    return b"".join(map(_vocabulary(raw), np.frombuffer(ids or b"", "<u4").tolist()))


def encode_column(spark, text: Column, ranks_path: str, pattern: str) -> Column:
    """Token ids of ``text`` as little-endian unsigned 32-bit integers, one after the other.

    Null and empty texts have no tokens (empty binary). Each match of ``pattern`` is encoded by itself; a piece that
    is a token as a whole is that token.
    """
    vocabulary = spark.sparkContext.broadcast(driver_file(ranks_path))

    return map_values(lambda value: _encode(vocabulary.value, pattern, value), "binary", text)


def decode_column(spark, ids: Column, ranks_path: str) -> Column:
    """Bytes of packed token ids; null gives no bytes. An id outside the vocabulary fails the task."""
    vocabulary = spark.sparkContext.broadcast(driver_file(ranks_path))

    return map_values(lambda value: _decode(vocabulary.value, value), "binary", ids)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``token_ids``, ``n_tokens`` and ``decoded``, as of :func:`encode` and :func:`decode`, in one pass."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(driver_file(ranks_path))

    def both(value: str | None) -> tuple[bytes, bytes]:
        ids = _encode(vocabulary.value, pattern, value)
        return ids, _decode(vocabulary.value, ids)

    coded = docs.withColumn("_coded", map_values(both, "struct<token_ids:binary,decoded:binary>", F.col(text_col)))
    return coded.withColumns({
        "token_ids": F.col("_coded.token_ids"), "decoded": F.col("_coded.decoded"),
        "n_tokens": (F.octet_length("_coded.token_ids") / 4).cast("bigint")}).drop("_coded")


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (packed, see :func:`encode_column`) and ``n_tokens``; such columns are replaced."""
    ids = encode_column(docs.sparkSession, F.col(text_col), ranks_path, pattern)
    return docs.withColumn("token_ids", ids).withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("bigint"))


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "token_ids") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its packed token ids."""
    return encoded.withColumn("decoded", decode_column(encoded.sparkSession, F.col(ids_col), ranks_path))
