"""Removed repeats against a dictionary of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from mercato.llm import queries, repeats


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append((len(b), int(gone.sum()), len(repeats._spans(gone)) // 2, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdé "])
def test_transform_is_brute_force(alphabet):
    rng = random.Random(len(alphabet))
    for length in (1, 2, 5, 9, 30):
        texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))).encode() for _ in range(12)]
        texts += [texts[0] + texts[1], texts[2][3:] + texts[0]]
        signs = np.concatenate([np.append(np.frombuffer(t, np.uint8).astype(np.uint16) + 1, 0).astype(np.uint16) for t in texts])
        got, at = repeats.repeated_starts(signs, length), 0
        seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
        for t in texts:
            for i in range(len(t) - length + 1):
                assert got[at + i] == (seen[t[i:i + length]] > 1)
            at += len(t) + 1


def made_up(seed, kinds=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgé", k=rng.randint(2, 7)))
    base = [" ".join(word() for _ in range(rng.randint(3, 60))) for _ in range(kinds)]
    shared = " ".join(word() for _ in range(20))
    texts = []
    for i, t in enumerate(base):
        texts.append((i, t))
        if i % 3 == 0:
            texts.append((100 + i, t.replace("a", "x", 1)))
        if i % 4 == 0:
            texts.append((200 + i, base[i - 1][-50:] + shared + t[:80]))
    return texts + [(1, base[1]), (None, base[2]), (None, base[2]), (500, None), (501, ""), (502, "ab" * 200), (503, "short")]


@pytest.mark.parametrize("most", [1500, 1])
def test_operator_is_brute_force(spark, docs, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST_KINDS", most)
    rows = made_up(3)
    got = repeats.remove_repeats(docs(rows), length=40, anchor=16).collect()
    want = [(i, *r) for (i, _), r in zip(rows, brute([t for _, t in rows], 40))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(((r[0], *r[1:4], bytes(r["kept"])) for r in got), key=key) == sorted(want, key=key)
    assert repeats.remove_repeats(docs([])).count() == 0


def test_chunks_of_a_long_text(monkeypatch):
    text = "".join(random.Random(5).choices("abc", k=3000)).encode()
    whole = list(repeats.contexts(text, 40, 16))
    monkeypatch.setattr(repeats, "CHUNK", 100)
    parts = list(repeats.contexts(text, 40, 16))
    pick = lambda found: {w: h for h, a, b in found for w in range(a, b)}
    assert pick(whole) == pick(parts) and len(pick(whole)) == 3000 - 39


def test_query_is_brute_force(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()
    want = [(i, *r[:3], hashlib.sha256(r[3]).hexdigest(), r[1] > 0) for (i, _), r in zip(rows, brute([t for _, t in rows], 400))]
    got = sorted(tuple(r) for r in queries.all_queries()["op2_suffix_dedup"](spark, folder).collect())
    assert got == want and sum(r[2] for r in want) > 0
