"""Closed syncmers against a plain search, and compared edits against whole fingerprints."""

import hashlib
import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from mercato.llm import queries, syncmers
from mercato.llm.syncmers import K, PIECE, S, WINDOW


def signed(value, bits=64):
    return value - (1 << bits) if value >> (bits - 1) else value


def digest(raw, seed=42):
    return xxhash.xxh64_intdigest(raw, seed)


def plain_anchors(raw):
    hashes = [signed(digest(raw[i:i + S])) for i in range(len(raw) - S + 1)]
    out = []
    for i in range(len(raw) - K + 1):
        inner = hashes[i:i + WINDOW]
        if min(inner) in (inner[0], inner[-1]):
            out.append((i, signed(digest(raw[i:i + K]))))
    return out


def plain_codes(raw):
    found = plain_anchors(raw)
    if not found:
        return [signed(digest(raw) >> 32, 32)] if raw else []
    ends = [b[0] - a[0] for a, b in zip(found, found[1:])] + [0]
    return [
        signed(digest(struct.pack("<i", gap), digest(struct.pack("<q", code))) >> 32, 32)
        for (_, code), gap in zip(found, ends)]


def plain_likeness(a, b):
    return 1.0 if not a and not b else 2 * len(set(a) & set(b)) / (len(set(a)) + len(set(b)))


def prose(seed, words):
    pick = random.Random(seed)
    return " ".join(pick.choice(["tion", "être", "the", "onre", "ing", "语言", "ha"]) + pick.choice("abcdé") for _ in range(words))


TEXTS = [
    "", "a", "short text", "x" * (K - 1), "y" * K, "z" * (K + 1), "ab" * 300, prose(1, 40), prose(2, 900), prose(3, 2500),
    "q" * 9000, prose(4, 60) + "\x00" + prose(5, 60), prose(6, 200)[:PIECE], "😀" * 50 + prose(7, 30), None]


def test_anchors_are_those_of_a_plain_search(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    raw = F.encode("text", "UTF-8")
    got = {r[0]: [tuple(a) for a in r[1]] for r in rows.select("doc_id", syncmers.anchors(raw)).collect()}
    for i, text in enumerate(TEXTS):
        assert got[i] == plain_anchors((text or "").encode()), i
    assert all(r["codes"] == plain_codes((r["text"] or "").encode()) for r in syncmers.fingerprints(rows).collect())


def expected(docs):
    """Rows by falling id; ties by the hash of id and text that the operator documents are left to the caller."""
    out = []
    for (doc_id, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        text, following = text or "", following or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        a, b, c = (plain_codes(t.encode()) for t in (text, edited, following))
        out.append((doc_id, len(text), edited, a, b, plain_likeness(a, b), plain_likeness(a, c)))
    return out


def test_edits_against_whole_fingerprints(docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, prose(i % 7, 30 + 9 * i)) for i in range(30)]
    got = syncmers.compare_edits(docs(rows)).orderBy(F.desc("doc_id")).collect()
    for row, wanted in zip(got, expected(sorted(rows, reverse=True)), strict=True):
        assert tuple(row)[:5] == wanted[:5]
        assert row["near_edited"] == pytest.approx(wanted[5]) and row["near_next"] == pytest.approx(wanted[6])


def test_null_ids_and_repeated_rows(docs):
    long = prose(9, 80)
    got = syncmers.compare_edits(docs([(5, long), (5, long), (None, "end"), (2, "abcdef")])).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited"]) for r in got) == sorted([
        ("5", len(long), long[:len(long) - len(long) // 3] + "abcdef")] * 2 + [
        ("2", 6, "abcden"), ("None", 3, "en" + long[0])])


def test_single_and_no_documents(docs):
    (row,) = syncmers.compare_edits(docs([(1, "abcdef")])).collect()
    assert row["edited"] == "abcdab" and row["near_next"] == 1.0
    assert syncmers.compare_edits(docs([])).collect() == []


def test_shifted_passage_is_found(spark):
    text = prose(11, 400)
    a, b = (plain_codes(t.encode()) for t in (text, "some words in front " + text))
    assert plain_likeness(a, b) > 0.95


def test_plan_is_native_and_shuffles_texts_once(spark):
    plan = queries.all_queries()["op12_syncmers"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_query(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted(((r["doc_id"], r["text"]) for r in given.select("doc_id", "text").collect()), reverse=True)
    got = queries.all_queries()["op12_syncmers"](spark, "/root/testdata/sf0.001").orderBy(F.desc("doc_id")).collect()

    def text_of(found):
        return "".join(f"{c & 0xFFFFFFFF:08x}" for c in found)

    for row, (doc_id, chars, edited, a, b, near, apart) in zip(got, expected(rows), strict=True):
        assert (row["doc_id"], row["n_chars"]) == (doc_id, chars)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (row["fingerprint"], row["edited_fingerprint"]) == (text_of(a), text_of(b))
        assert (row["near_edited"], row["near_next"]) == (pytest.approx(near), pytest.approx(apart))
