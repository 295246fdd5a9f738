"""Contamination: planted copies are found, clean texts are not, and scores are those of a plain alignment."""

import random
import re

import numpy as np
import pytest

from mercato.llm import decontaminate, queries, words

SMALL = "/root/testdata/sf0.01"
RNG = random.Random(11)
VOCABULARY = ["".join(RNG.choices("abcdefghij", k=RNG.randint(2, 6))) for _ in range(3000)]


def prose(n, rng=RNG):
    return " ".join(rng.choices(VOCABULARY, k=n))


def plain_score(a, b):
    row, best = [0] * (len(b) + 1), 0
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        row, best = new, max(best, *new)
    return best / (2 * len(a))


def test_alignment_is_plain_smith_waterman():
    rng = random.Random(2)
    for _ in range(60):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(1, 25))] for _ in range(2))
        assert decontaminate.alignment_score(np.array(a), np.array(b)) == pytest.approx(plain_score(a, b))


def test_words_and_grams():
    texts = ["One, two--three FOUR été", "", None, "a b c d e", "!!"]
    (found,) = words.blocks(texts)
    assert [found.block[a:b].decode() for a, b in zip(found.starts, found.ends)] == [
        "One", "two", "three", "FOUR", "été", "a", "b", "c", "d", "e"]
    assert found.text.tolist() == [0] * 5 + [3] * 5
    assert len(found.grams(4)[0]) == 4
    (again,) = words.blocks(["x one TWO three four"])
    assert set(again.hashes[1:5].tolist()) == set(found.hashes[:4].tolist())


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_planted_copies(spark, docs):
    items = [(i, prose(30)) for i in range(20)] + [(90, items_text := prose(25)), (91, items_text), (92, "too short"), (93, None), (94, "")]
    edited = items[3][1].split()
    for at in (5, 12, 20, 26):
        edited[at] = "zzz"
    del edited[16]
    rows = [(i, prose(200)) for i in range(40)]
    rows += [(100, prose(50) + " " + items[0][1].upper() + ", " + prose(50)), (101, prose(9) + " " + " ".join(edited)),
             (102, items_text), (103, items[5][1][:40] + prose(30)), (104, None), (105, ""), (106, "too short"),
             (100, "another"), (107, " ".join([prose(6000), items[7][1], prose(4000), items[8][1]])),
             (None, items[1][1]), (108, items[2][1]), (108, items[2][1])]
    found = decontaminate.find_contamination(docs(rows), items_of(spark, items)).collect()
    assert sorted((r["doc_id"] or -1, r["item_id"]) for r in found) == [
        (-1, 1), (100, 0), (101, 3), (102, 90), (102, 91), (107, 7), (107, 8), (108, 2), (108, 2)]
    assert {r["score"] for r in found if r["doc_id"] != 101} == {1.0}
    kept = decontaminate.drop_contaminated(docs(rows), items_of(spark, items))
    gone = {100, 101, 102, 107, 108}
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == sorted(
        (i, t or "") for i, t in rows if i is not None and (i not in gone or t == "another"))
    assert kept.columns == docs(rows).columns


def test_passages_that_everything_holds(spark, docs):
    leaked, boiler = prose(20), prose(5)
    items = [(i, f"{boiler} {prose(20)}") for i in range(12)] + [(50, leaked), (51, boiler)]
    rows = [(i, f"{prose(30)} {leaked if i % 3 == 0 else ''} {prose(10)}") for i in range(30)]
    found = decontaminate.find_contamination(docs(rows), items_of(spark, items)).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(i, 50) for i in range(0, 30, 3)]


def test_one_seed_that_many_passages_hold(spark, docs):
    edited, four = prose(15), prose(4)
    copy = edited.split()
    for at in (4, 8, 12):  # one run of four words is left
        copy[at] = "zzz"
    rows = [(i, " ".join([*(copy if i % 2 else four.split()), prose(20)])) for i in range(120)]
    rows += [(200 + i, " ".join(["q", *copy, "q"])) for i in range(60)]
    found = decontaminate.find_contamination(docs(rows), items_of(spark, [(1, edited), (2, four)])).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [
        *((i, 1 if i % 2 else 2) for i in range(120)), *((200 + i, 1) for i in range(60))]


def test_dense_edits_and_scripts_without_spaces(spark, docs):
    def cut(text):
        return re.findall(r"[\u4e00-\u9fff\u0e00-\u0e7f]|[a-z]+", text)

    chinese, thai = "我们今天在图书馆学习数据处理的方法", "วันนี้อากาศดีมากเราไปเดินเล่นกัน"
    items = [(1, prose(15)), (2, prose(16)), (3, prose(3)), (4, chinese), (5, thai)]
    items += [(10 + i, f"{items[0][1].split()[0]} {prose(12)}") for i in range(10)]
    rows = [(i, prose(40)) for i in range(10)]
    for doc_id, (_, text), places in ((100, items[0], (3, 7, 11, 14)), (101, items[0], (3, 7, 11)), (102, items[1], (3, 7, 11, 15))):
        copy = text.split()
        for at in places:
            copy[at] = "zzz"
        rows.append((doc_id, " ".join([prose(9), *copy, prose(9)])))
    rows += [(103, f"{prose(5)} {items[2][1]} {prose(5)}"), (104, f"他说{chinese}很好"), (105, f"{prose(4)} {chinese[:7]}呢{chinese[8:]}"),
             (106, thai), (107, "完全不同的一句话没有关系")]
    want = {(d, i): score for d, t in rows for i, item in items if (score := plain_score(cut(item), cut(t))) >= 0.5}
    found = decontaminate.find_contamination(docs(rows), items_of(spark, items)).collect()
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in found} == pytest.approx(want)
    assert set(want) == {(100, 1), (101, 1), (102, 2), (103, 3), (104, 4), (105, 4), (106, 5)}


@pytest.mark.parametrize("least", [0.5, 0.8])
def test_bound_spares_no_score(least):
    rng = random.Random(5)
    found = 0
    for _ in range(150):
        item = prose(rng.randint(3, 20), rng).split()
        copy = [w for w in item if rng.random() > 0.1]
        for _ in range(rng.randint(0, 3)):
            copy.insert(rng.randint(0, len(copy)), rng.choice(["zzz", "yyy"]))
        passage = prose(60, rng).split() + copy + prose(rng.randint(0, 90), rng).split() + item[:3] + prose(200, rng).split()
        whole = plain_score(item, passage)
        want = whole if whole >= least else 0
        got = decontaminate.copy_score(" ".join(item), " ".join(passage), least)
        assert (got if got >= least else 0) == pytest.approx(want)
        found += want > 0
    assert found > 40


def test_a_very_long_text_and_a_very_long_item(spark, docs):
    item, book = prose(12), prose(3000)
    rows = [(1, " ".join([prose(200_000), item, prose(1000)])), (2, prose(50_000)), (3, f"{item} {prose(40)}")]
    found = decontaminate.find_contamination(docs(rows), items_of(spark, [(1, item), (2, book)])).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (3, 1)}


def test_edited_copies_that_are_found(spark, docs):
    """Recall on copies of which about one word in seven is replaced, dropped or put in."""
    rng = random.Random(8)
    items = [(i, prose(rng.randint(12, 40), rng)) for i in range(100)]
    rows, reach = [], set()
    for i, text in items:
        copy = []
        for word in text.split():
            change = rng.random()
            copy += [rng.choice(VOCABULARY)] if change < 0.05 else [] if change < 0.1 else [word, "new"] if change < 0.15 else [word]
        if plain_score(text.split(), copy) >= 0.5:
            reach.add((i, i))
        rows.append((i, " ".join([prose(30, rng), *copy, prose(30, rng)])))
    found = decontaminate.find_contamination(docs(rows), items_of(spark, items)).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert len(reach) > 90 and got == reach


def test_empty_tables(spark, docs):
    assert decontaminate.find_contamination(docs([]), items_of(spark, [(1, prose(20))])).count() == 0
    assert decontaminate.find_contamination(docs([(1, prose(20))]), items_of(spark, [])).count() == 0


def test_query_finds_what_brute_force_finds(spark):
    """Every item is aligned with every whole document, without seeds."""
    split = lambda t: np.array([hash(w) for w in re.findall(r"[^\W_]+", t.lower())])
    docs = {r["doc_id"]: split(r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = {r["item_id"]: split(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    want = {
        (d, i): round(score, 6) for d, passage in docs.items() for i, item in items.items()
        if np.isin(item, passage).mean() >= 0.5 and (score := decontaminate.alignment_score(item, passage)) >= 0.5}
    found = queries.all_queries()["op6_decontaminate"](spark, SMALL).collect()
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in found} == pytest.approx(want) and want
