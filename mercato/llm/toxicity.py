"""Toxicity: a chain of linear classifiers over words and their openings.

Categories are predicted one after the other; each model sees the words of a text, the openings of longer words
(as in compounds and inflected forms) and the predicted probabilities of the categories before it. For training these
come from out-of-fold models, so that a later model learns from predictions as uncertain as those it will meet.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.words import Words, blocks
from mercato.session import materialise

SAMPLE = 6000  # labelled texts that the models are fitted on, at most; those of least hash
OPENINGS = range(4, 10)  # bytes
LEAST_TEXTS = 3  # sampled texts that hold a word for it to be a feature
LEAST_APART = 5.0  # standard deviations between a category's share in them and chance
FOLDS = 5
PENALTY = 0.5
STEPS = 20


@dataclass
class Chain:
    """Models of the categories in turn: rows of ``weights`` are the features named by ``columns``, then the
    probabilities of earlier categories."""

    categories: list[str]
    words: np.ndarray  # sorted hashes
    columns: list[np.ndarray]
    weights: list[np.ndarray]
    biases: list[float]
    thresholds: list[float]

    def log_odds(self, present: np.ndarray) -> np.ndarray:
        """Log odds of each category, a column each, for rows of 0 and 1 per word."""
        out = earlier = np.zeros((len(present), 0), np.float32)
        for columns, weights, bias in zip(self.columns, self.weights, self.biases):
            odds = np.column_stack([present[:, columns], earlier]) @ weights + bias
            out, earlier = np.column_stack([out, odds]), np.column_stack([earlier, _sigmoid(odds)])
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with a squared penalty, by Newton's method. One class alone: its base rate."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    weights, bias = np.zeros(x.shape[1], np.float32), float(np.log(rate / (1 - rate)))
    if y.min() == y.max() or not x.shape[1]:
        return weights, bias
    both = np.column_stack([x, np.ones(len(x), np.float32)])
    now = np.append(weights, bias).astype(np.float64)
    pull = np.full(len(now), PENALTY)
    pull[-1] = 1e-6  # the base rate is not held back
    for _ in range(STEPS):
        p = _sigmoid(both @ now.astype(np.float32)).astype(np.float64)
        grade = both.T @ (p - y).astype(np.float32) + pull * now
        curved = both * np.sqrt(p * (1 - p) + 1e-6).astype(np.float32)[:, None]
        move = np.linalg.solve((curved.T @ curved).astype(np.float64) + np.diag(pull), grade)
        now -= move * min(1.0, 5.0 / np.abs(move).max())
        if np.abs(move).max() < 1e-4:
            break
    return now[:-1].astype(np.float32), float(now[-1])


def _best_threshold(odds: np.ndarray, y: np.ndarray) -> float:
    """Log odds above which the F1 score of out-of-fold predictions is best; infinite where no cut is right more
    often than not."""
    order = np.argsort(-odds, kind="stable")
    ranked, hits = odds[order], np.cumsum(y[order])
    found = np.arange(1, len(y) + 1)
    below = np.append(ranked[1:], -np.inf)
    score = np.where((ranked > below) & (2 * hits > found), 2 * hits / (found + y.sum()), 0)
    if not len(y) or not score.max() > 0:
        return float("inf")
    best = int(np.argmax(score))
    return float(ranked[best] - 1 if best + 1 == len(y) else (ranked[best] + below[best]) / 2)


def fit_chain(
    present: np.ndarray, labels: np.ndarray, folds: np.ndarray, words: np.ndarray, columns: list[np.ndarray],
    categories: list[str],
) -> Chain:
    """``labels``: a column of 0, 1 or NaN (unknown) per category. Rows without a label train the other categories only."""
    chain = Chain(categories, words, columns, [], [], [])
    earlier = np.zeros((len(present), 0), np.float32)
    for column in range(len(categories)):
        y = labels[:, column]
        known = ~np.isnan(y)
        x = np.column_stack([present[:, columns[column]], earlier]).astype(np.float32)
        odds = np.zeros(len(x), np.float32)
        for fold in range(FOLDS):
            weights, bias = _fit_known(x, y, known & (folds != fold))
            odds[folds == fold] = x[folds == fold] @ weights + bias
        weights, bias = _fit_known(x, y, known)
        chain.weights.append(weights)
        chain.biases.append(bias)
        chain.thresholds.append(_best_threshold(odds[known], y[known]))
        earlier = np.column_stack([earlier, _sigmoid(odds)])
    return chain


def _fit_known(x: np.ndarray, y: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, float]:
    if not rows.any():
        return np.zeros(x.shape[1], np.float32), -30.0  # nothing is known of the category: never
    return fit_linear(x[rows], y[rows].astype(np.float32))


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number of the text) of all words and openings."""
    hashes, texts = [words.hashes], [words.text]
    for size in OPENINGS:
        opening, word = words.openings(size)
        hashes.append(opening)
        texts.append(words.text[word])
    return np.concatenate(hashes), np.concatenate(texts)


def _feature_sets(batches):
    """Different features of each text, by their hashes."""
    for batch in batches:
        found = []
        for words in blocks(text.as_py() for text in batch.column(1)):
            hashes, texts = _features(words)
            by = np.lexsort((hashes, texts))
            hashes, texts = hashes[by], texts[by]
            fresh = np.ones(len(by), bool)
            fresh[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
            found += np.split(hashes[fresh].view(np.int64), np.searchsorted(texts[fresh], np.arange(1, words.texts)))
        yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["number", "words"])


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """Fit a chain of ``categories`` (name -> SQL of a 0/1 label over ``labels``), in their order.

    Read are at most ``SAMPLE`` different labelled texts, those of least hash, whole. Of several labels of an id or of
    equal texts the largest holds; null labels are unknown, labels of null ids or without a document are ignored, and a
    null text is an empty one. Without labels the chain finds nothing. A feature of a category is any word or opening
    that tells it in the sample; other columns of ``docs`` may have any name.
    """
    known = [F.expr(sql).cast("double").alias(f"label_{i}") for i, sql in enumerate(categories.values())]
    names = [f"label_{i}" for i in range(len(known))]
    of_id = labels.select(F.col(id_col).alias("id"), *known).groupBy("id").agg(*(F.max(n).alias(n) for n in names))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    texts = texts.select("id", F.xxhash64("text").alias("number"), "text")
    chosen = (
        texts.select("id", "number").join(of_id, "id").groupBy("number").agg(*(F.max(n).alias(n) for n in names))
        .orderBy("number").limit(SAMPLE))
    chosen = materialise(chosen, "labelled")
    sample = texts.select("number", "text").join(F.broadcast(chosen), "number")
    sample = materialise(sample.groupBy("number").agg(F.min("text").alias("text"), *(F.max(n).alias(n) for n in names)), "sample")
    words = materialise(
        sample.select("number", "text").mapInArrow(_feature_sets, "number long, words array<long>"), "sample-words")
    target = sample.select("number", *(F.coalesce(n, F.lit(0.0)).alias(n) for n in names))
    each = words.select("number", F.explode("words").alias("word")).join(target, "number")
    counted = each.groupBy("word").agg(F.count("*").alias("texts"), *(F.sum(n).alias(n) for n in names))
    total = target.agg(F.count("*").alias("n"), *(F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names)).collect()[0]
    apart = []
    for name in names:
        rate = (total[name] + 0.5) / (total["n"] + 1)
        apart.append(F.abs(F.col(name) - rate * F.col("texts")) / F.sqrt(F.col("texts") * rate * (1 - rate)))
    tells = [a >= LEAST_APART for a in apart]
    features = materialise(
        counted.filter((F.col("texts") >= LEAST_TEXTS) & F.array_contains(F.array(*tells), True))
        .select("word", F.array(*tells).alias("tells")), "features")
    told = sorted((r["word"] % (1 << 64), r["tells"]) for r in features.collect())
    vocabulary = np.array([word for word, _ in told], np.uint64)
    columns = [np.flatnonzero([tells[i] for _, tells in told]) for i in range(len(names))]
    rows = sample.select("number", *names).orderBy("number").collect()  # SAMPLE rows at most, without texts
    place = {r["number"]: i for i, r in enumerate(rows)}
    present = np.zeros((len(rows), len(vocabulary)), np.float32)
    holds = words.select("number", F.explode("words").alias("word")).join(F.broadcast(features.select("word")), "word")
    for row in holds.groupBy("number").agg(F.collect_list("word").alias("words")).collect():  # SAMPLE rows at most
        present[place[row["number"]], np.searchsorted(vocabulary, np.array(row["words"], np.int64).view(np.uint64))] = 1
    table = np.array([[np.nan if r[n] is None else r[n] for n in names] for r in rows], np.float64).reshape(len(rows), len(names))
    folds = np.array([r["number"] % FOLDS for r in rows], np.int64)
    return fit_chain(present, table, folds, vocabulary, columns, list(categories))


def _log_odds(chain: Chain, texts) -> np.ndarray:
    found = [np.zeros((0, len(chain.categories)), np.float32)]
    size = len(chain.words)
    for words in blocks(texts):
        present = np.zeros((words.texts, size), np.float32)
        if size:
            hashes, texts = _features(words)
            at = np.minimum(np.searchsorted(chain.words, hashes), size - 1)
            hit = np.flatnonzero(chain.words[at] == hashes)
            present[texts[hit], at[hit]] = 1
        found.append(chain.log_odds(present))
    return np.concatenate(found)


def score(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """``docs`` with ``p_<category>`` (probability) and ``<category>`` (boolean: over its threshold) for each category.

    Columns of these names are replaced. A null, empty or wordless text has the models' base rates and is in no
    category; repeated rows are scored alike, and an empty table stays empty. Whole texts are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # words that tell a category in SAMPLE texts

    def odds(batches):
        for texts in batches:
            found = _log_odds(shared.value, (t.as_py() for t in texts)).astype(np.float64)
            yield pa.array(found.tolist(), pa.list_(pa.float64()))

    from collections.abc import Iterator

    odds.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    scored = docs.withColumn("_odds", F.arrow_udf(odds, "array<double>")(F.col(text_col)))
    made = {}
    for i, name in enumerate(chain.categories):
        made[f"p_{name}"] = 1 / (1 + F.exp(-F.col("_odds")[i]))
        made[name] = (F.col("_odds")[i] > F.lit(chain.thresholds[i])) & (F.length(F.trim(F.coalesce(text_col, F.lit("")))) > 0)
    return scored.withColumns(made).drop("_odds")
