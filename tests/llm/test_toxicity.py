"""The chain by held-out accuracy, and its odd inputs."""

import random

import numpy as np

from mercato.llm import queries, toxicity

RNG = random.Random(4)
WORDS = ["".join(RNG.choices("abcdefgh", k=4)) for _ in range(300)]
BAD = ["idiot", "moron", "scum"]


def made(n, start=0):
    rows, labels = [], []
    for i in range(start, start + n):
        rough, toxic = i % 3 == 0, i % 4 == 0
        text = RNG.choices(WORDS, k=RNG.randint(20, 120)) + (["spam", "junk"] if rough else []) + ([RNG.choice(BAD)] * 2 if toxic else [])
        RNG.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(not rough), int(toxic)))
    return rows, labels


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, docs):
    rows, labels = made(1200)
    chain = toxicity.train(docs(rows), labels_of(spark, labels), queries.TOXIC_CHAIN)
    assert chain.categories == ["low_quality", "toxic"] and [len(w) - len(c) for w, c in zip(chain.weights, chain.columns)] == [0, 1]
    fresh, truth = made(600, 5000)
    scored = {r["doc_id"]: r for r in toxicity.score(docs(fresh), chain).collect()}
    assert np.mean([scored[i]["toxic"] == bool(t) for i, _, t in truth]) > 0.98
    assert np.mean([scored[i]["low_quality"] == (not q) for i, q, _ in truth]) > 0.98


def test_odd_texts_and_labels(spark, docs):
    rows, labels = made(400)
    labels += [(0, None, None), (None, 1, 1), (1, 1, 0), (99_999, 1, 1)]
    chain = toxicity.train(docs(rows), labels_of(spark, labels), queries.TOXIC_CHAIN)
    clashing = docs(rows).withColumnsRenamed({"fingerprint": "labelled", "pii": "number", "lang": "label_0", "source": "word"})
    again = toxicity.train(clashing.unionByName(clashing), labels_of(spark, labels), queries.TOXIC_CHAIN)
    assert again.thresholds == chain.thresholds and (again.words == chain.words).all()
    odd = docs([(1, None), (2, ""), (3, " \n!"), (4, "idiot moron scum " * 20_000), (4, "idiot moron scum " * 20_000)])
    scored = toxicity.score(odd.withColumnRenamed("source", "toxic"), chain)
    assert [(r["doc_id"], r["toxic"]) for r in scored.orderBy("doc_id").collect()] == [
        (1, False), (2, False), (3, False), (4, True), (4, True)]
    assert toxicity.score(docs([]), chain).count() == 0


def test_chain_is_its_models_one_after_another():
    rng = np.random.default_rng(3)
    present = rng.integers(0, 2, (400, 6)).astype(np.float32)
    first = present[:, 0] > 0
    labels = np.column_stack([first, first & (present[:, 1] > 0)]).astype(np.float64)
    labels[:30, 0] = np.nan
    folds = np.arange(400) % toxicity.FOLDS
    columns = [np.array([0, 2]), np.array([1, 3])]
    chain = toxicity.fit_chain(present, labels, folds, np.arange(6, dtype=np.uint64), columns, ["a", "b"])

    known = ~np.isnan(labels[:, 0])
    held_out = np.zeros(400)
    for fold in range(toxicity.FOLDS):
        rows = known & (folds != fold)
        weights, bias = toxicity.fit_linear(present[rows][:, [0, 2]], labels[rows, 0].astype(np.float32))
        held_out[folds == fold] = 1 / (1 + np.exp(-(present[folds == fold][:, [0, 2]] @ weights + bias)))
    both = np.column_stack([present[:, [1, 3]], held_out]).astype(np.float32)
    weights, bias = toxicity.fit_linear(both, labels[:, 1].astype(np.float32))
    assert np.allclose(chain.weights[1], weights, atol=1e-3) and abs(chain.biases[1] - bias) < 1e-3

    odds = chain.log_odds(present)
    earlier = 1 / (1 + np.exp(-odds[:, 0]))  # the later model sees a probability
    assert np.allclose(odds[:, 1], np.column_stack([present[:, [1, 3]], earlier]) @ chain.weights[1] + chain.biases[1], atol=1e-4)


def test_labels_without_documents_use_up_no_sample(spark, docs, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 300)
    rows, labels = made(300)
    stray = [(10_000 + i, 1, 1) for i in range(3000)]
    chain = toxicity.train(docs(rows), labels_of(spark, labels + stray), queries.TOXIC_CHAIN)
    same = toxicity.train(docs(rows), labels_of(spark, labels), queries.TOXIC_CHAIN)
    assert chain.thresholds == same.thresholds and len(chain.words)


def test_without_labels_nothing_is_toxic(spark, docs):
    rows, labels = made(50)
    for known in ([], [(i, q, 0) for i, q, _ in labels]):
        chain = toxicity.train(docs(rows), labels_of(spark, known), queries.TOXIC_CHAIN)
        assert toxicity.score(docs(rows), chain).filter("toxic").count() == 0
    assert toxicity.score(docs(rows), toxicity.train(docs([]), labels_of(spark, labels), queries.TOXIC_CHAIN)).filter("toxic").count() == 0


def test_query_on_given_labels(spark):
    import duckdb

    folder = "/root/testdata/sf0.1"
    scored = {r["doc_id"]: r["toxic"] for r in queries.all_queries()["op7_toxicity"](spark, folder).collect()}
    truth = duckdb.sql(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall()
    hits = sum(scored[i] for i, t in truth if t)
    false = sum(scored[i] for i, t in truth if not t)
    assert len(scored) == 10_000 and hits > 340 and false < 12  # some labels are noise: 79 of 449 toxic texts hold no insult
