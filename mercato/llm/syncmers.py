"""Document fingerprints from closed syncmers, in built-in column functions alone.

Every run of ``K`` bytes of a text is judged by itself: it is an anchor if the least hash among its inner strings of
``S`` bytes is that of the first or the last one. Nothing around it matters (context-free), so an edit moves or removes
only the anchors that it touches, and the anchors of a text put together from two pieces are those of the pieces and
of the seam. A fingerprint lists, in order, one 32-bit code per anchor, made of its bytes and the distance to the next
anchor; equal codes in two fingerprints are the same passage with the next anchor at the same place behind it.

A text is taken in pieces of ``PIECE`` bytes that overlap by ``K - 1``, so arrays stay small however long it is.
Window minima are not computed for each window: a place whose hash is least among the ``WINDOW`` from it, or up to it,
lies in a block of ``BLOCK`` whose minimum is least among the blocks on that side, and only such blocks are looked at.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.session import materialise

S, WINDOW = 8, 32  # bytes of an inner string, and inner strings of an anchor
K = S + WINDOW - 1  # bytes of an anchor
BLOCK, PIECE = 4, 4096
_PART_BITS = 33  # monotonically_increasing_id: partition above, row within it below


def _once(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _upto(past: Column) -> Column:
    return F.sequence(F.lit(0), (past - 1).cast("int"))


def _least_places(hashes: Column, minima: Column, step: int) -> Column:
    """Places whose hash is least among the ``WINDOW`` hashes from there on (step 1) or up to there (step -1)."""
    def block(t: Column) -> Column:
        return reduce(and_, [F.get(minima, t) <= F.get(minima, t + step * j) for j in range(1, WINDOW // BLOCK)])

    def place(p: Column) -> Column:
        return reduce(and_, [F.get(hashes, p) <= F.get(hashes, p + step * j) for j in range(1, WINDOW)])

    blocks = F.filter(_upto(F.size(minima)), block)
    places = F.transform(blocks, lambda t: F.sequence(t * BLOCK, t * BLOCK + (BLOCK - 1)))
    return F.filter(F.flatten(places), place)  # a window that leaves the array meets a null and is dropped


def _chosen(hashes: Column) -> Column:
    """Starts of the anchors among the inner strings with these hashes, ascending."""
    def among(minima: Column) -> Column:
        first = _least_places(hashes, minima, 1)
        last = F.transform(_least_places(hashes, minima, -1), lambda p: p - (WINDOW - 1))
        return F.array_sort(F.array_union(first, last))

    minima = F.transform(
        _upto(F.ceil(F.size(hashes) / BLOCK)), lambda t: F.least(*[F.get(hashes, t * BLOCK + j) for j in range(BLOCK)]))
    return _once(minima, among)


def _piece_anchors(piece: Column, before: Column) -> Column:
    hashes = F.transform(
        F.sequence(F.lit(1), F.length(piece) - (S - 1)), lambda i: F.xxhash64(piece.substr(i, F.lit(S))))
    return F.transform(
        _once(hashes, _chosen),
        lambda i: F.struct((before + i).alias("at"), F.xxhash64(piece.substr(i + 1, F.lit(K))).alias("code")))


def anchors(raw: Column) -> Column:
    """Closed syncmers of bytes: array of (at: first byte, code: XXH64), in order. None in fewer than ``K`` bytes or null."""
    def cut(whole: Column) -> Column:
        pieces = F.transform(
            _upto(F.ceil((F.length(whole) - (K - 1)) / PIECE)),
            lambda c: _once(whole.substr(c * PIECE + 1, F.lit(PIECE + K - 1)), lambda p: _piece_anchors(p, c * PIECE)))
        return F.when(F.length(whole) >= K, F.flatten(pieces))

    return F.coalesce(_once(raw, cut), F.array().cast("array<struct<at:int,code:bigint>>"))


def _links(found: Column) -> Column:
    """32 bits of each anchor: of its bytes and the distance to the next one, 0 at the last."""
    return _once(found, lambda a: F.transform(
        a, lambda x, i: _code(F.xxhash64(x["code"], F.coalesce(F.get(a, i + 1)["at"] - x["at"], F.lit(0))))))


def _alone(raw: Column) -> Column:
    return F.when(F.length(raw) > 0, F.array(_code(F.xxhash64(raw)))).otherwise(F.array().cast("array<int>"))


def codes(found: Column, raw: Column) -> Column:
    """Fingerprint of ``anchors`` found in bytes: one code each. Without an anchor, bytes have one code, of them all; no
    bytes have none."""
    return _once(found, lambda a: F.when(F.size(a) > 0, _links(a)).otherwise(_alone(raw)))


def _code(hashed: Column) -> Column:
    return F.shiftright(hashed, 32).cast("int")


def hex_string(fingerprint: Column) -> Column:
    """Codes as hex digits, eight each, in order."""
    return F.array_join(
        F.transform(fingerprint, lambda c: F.lpad(F.lower(F.hex(c.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Shared share of two fingerprints, 0 to 1: twice the codes in both by those in either. Two empty ones are alike."""
    kinds = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(kinds == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / kinds)


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``codes``, the fingerprint of each text's UTF-8 (a column of that name is replaced).

    Null texts count as empty and have no codes; texts of fewer than ``K`` bytes, or without an anchor, have one code.
    Equal texts have equal fingerprints. Rows stay as they are, repeated ones too; no shuffle.
    """
    raw = F.coalesce(F.encode(text_col, "UTF-8"), F.lit(b""))
    return docs.withColumn("codes", codes(anchors(raw), raw))


def _keys(id_col: str, text_col: str) -> list[Column]:
    return [F.xxhash64(id_col, text_col).alias("k1"), F.xxhash64(F.lit(1), text_col, id_col).alias("k2")]


def _third(chars: Column) -> Column:
    return F.floor(chars / 3).cast("int")


def _distinct(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each (id, text) once: a key of two hashes and ``doc``. Copies collapse before the shuffle.

    ``doc`` holds id, text, codes and what an edit of the last third leaves: kept bytes, how many anchors lie wholly in
    them, and the last of these. It is one column, so that all who read the shuffle read the same.
    """
    text, raw = F.col("text"), F.encode("text", "UTF-8")
    chars = F.length("text")
    found = docs.select(
        *_keys(id_col, text_col), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumns({"found": anchors(raw), "kept": F.octet_length(F.left(text, chars - _third(chars)))})
    staying = F.size(F.filter("found", lambda x: x["at"] + K <= F.col("kept")))
    marked = found.withColumn("staying", staying).select("k1", "k2", F.struct(
        "id", "text", codes(F.col("found"), raw).alias("codes"), "kept", "staying",
        F.get("found", F.col("staying") - 1).alias("last")).alias("doc"))
    return marked.groupBy("k1", "k2").agg(F.first("doc").alias("doc"))


def _successors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k1, k2) of each document with (p1, p2, chars, copies) of the one that it follows, by falling id, the first after
    the last.

    Sorted by range over keys alone; a row's successor is the next row of its partition, and the last row's is the first
    of the next partition, of which the driver has one row each.
    """
    keys = (
        docs.select(
            *_keys(id_col, text_col), F.col(id_col).alias("id"), F.coalesce(F.length(text_col), F.lit(0)).alias("chars"))
        .groupBy("k1", "k2").agg(F.first("id").alias("id"), F.first("chars").alias("chars"), F.count("*").alias("copies")))
    order = [F.col("id").desc_nulls_last(), F.col("k1"), F.col("k2")]
    placed = (
        keys.repartitionByRange(*order).sortWithinPartitions(*order).select("k1", "k2", "chars", "copies")
        .withColumn("place", F.monotonically_increasing_id()))
    placed = materialise(placed, "document-order")  # range bounds are sampled, so places are settled before they are joined
    parts = (
        placed.groupBy(F.shiftright("place", _PART_BITS).alias("part"))
        .agg(F.min("place").alias("first"), F.max("place").alias("last")).orderBy("part").collect())
    firsts = [p["first"] for p in parts]
    jumps = docs.sparkSession.createDataFrame(
        [(p["last"], first) for p, first in zip(parts, firsts[1:] + firsts[:1])], "place long, jump long")
    before = placed.join(F.broadcast(jumps), "place", "left").select(  # one row a partition
        F.coalesce("jump", F.col("place") + 1).alias("place"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        "chars", "copies")
    return materialise(placed.select("place", "k1", "k2").join(before, "place").drop("place"), "successors")


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What an edit of the last third and a change of document do to each fingerprint.

    Returns ``id_col``, n_chars, edited (text), codes, edited_codes, near_edited, next_id and near_next. The edited text is the
    document's own with its last floor(n_chars / 3) code points replaced by the first as many, or all, of the next
    document by falling id, the first one's after the last. Null texts count as empty. Null ids come last; equal
    ids in the order of a hash of id and text. Repeated rows, of equal id and text, are one document in that order and all
    returned. A single document is its own next; an empty table gives no rows. No other column is read.

    Texts are shuffled once, by a key of their own, with their codes, and read from that shuffle twice: the part that a
    document gives to the one before it comes to that one's place. Of the edited text only the part that is new, and
    the seam, is searched for anchors; all others are the document's own.
    """
    own = _distinct(docs, id_col, text_col)
    coming = own.join(_successors(docs, id_col, text_col), ["k1", "k2"]).select(
        F.col("p1").alias("k1"), F.col("p2").alias("k2"), "copies", F.col("doc.id").alias("next_id"),
        F.left(F.col("doc.text"), _third(F.col("chars"))).alias("coming"), F.col("doc.codes").alias("next_codes"))
    chars = F.length("doc.text")
    met = own.join(coming, ["k1", "k2"]).select(
        "doc", "copies", "next_id", "next_codes", chars.cast("bigint").alias("n_chars"),
        F.concat(F.left(F.col("doc.text"), chars - _third(chars)), F.col("coming")).alias("edited"))
    edited = F.encode("edited", "UTF-8")
    seam = F.greatest(F.lit(0), F.col("doc.kept") - (K - 1))  # the first string that holds a new byte starts here
    new = F.transform(
        anchors(edited.substr(seam + 1, F.length(edited))),
        lambda x: F.struct((x["at"] + seam).alias("at"), x["code"].alias("code")))
    ending = F.concat(F.filter(F.array("doc.last"), lambda x: x.isNotNull()), new)  # the last one that stays has a new next
    judged = met.withColumn("ending", ending).withColumn("edited_codes", F.when(
        F.size("ending") > 0,
        F.concat(F.slice("doc.codes", F.lit(1), F.greatest(F.col("doc.staying") - 1, F.lit(0))), _links(F.col("ending")))
    ).otherwise(_alone(edited)))
    own_codes = F.col("doc.codes")
    return judged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select(
        F.col("doc.id").alias(id_col), "n_chars", "edited", own_codes.alias("codes"), "edited_codes",
        likeness(own_codes, F.col("edited_codes")).alias("near_edited"), "next_id",
        likeness(own_codes, F.col("next_codes")).alias("near_next"))
