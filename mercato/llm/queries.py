"""Registered queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import bpe, decontaminate, negatives, pii, repeats, secrets, simhash, syncmers, token_files, topk, toxicity, url_filter, whitening
from mercato.llm.common import ship_package, table
from mercato.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
BYTE_RANKS, WORD_TOKENIZER = "byte_bpe_50k.tiktoken", "word_bpe_49k.json"

URL_RULES = [  # host, path, verdict
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return build(spark, sf_dir)

    _QUERIES[build.__name__] = run
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


@query
def op2_suffix_dedup(spark, sf_dir):
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_removed") > 0).alias("has_repeat"))


@query
def op3_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def _of_kind(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


@query
def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_byte_bpe(spark, sf_dir):
    import public_tokenizers

    ranks = public_tokenizers.path(BYTE_RANKS)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op5_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = secrets.find_secrets(
        docs, ["doc_id"], "text", owner=F.col("source"), repository=F.concat_ws("/", "source", "lang"))
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.withColumn("base", base).select(
        "doc_id", *(_of_kind("base", kind) for kind in secrets.BASE_KINDS),
        F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("secrets").alias("spans"),
        F.size(F.filter("secrets", lambda s: s["live"])).cast("bigint").alias("n_live"))


@query
def op6_decontaminate(spark, sf_dir):
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("score", 6).alias("score"))


TOXIC_CHAIN = {"low_quality": "1 - quality", "toxic": "toxic"}


@query
def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), TOXIC_CHAIN)
    return toxicity.score(docs, chain).drop("text")


@query
def op8_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query
def op9_token_files(spark, sf_dir):
    import public_tokenizers

    folder = scratch_path(spark, "token-files")
    index = token_files.write_token_files(
        table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORD_TOKENIZER), names_as_text=False)
    return token_files.read_checksums(index, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op10_pii(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("base", F.filter("pii", lambda s: s["plain"])).select(
        "doc_id", *(_of_kind("base", kind) for kind in pii.KINDS),
        F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("pii").alias("spans"))


@query
def op11_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op12_syncmers(spark, sf_dir):
    compared = syncmers.compare_edits(table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), syncmers.hex_string(F.col("codes")).alias("fingerprint"),
        syncmers.hex_string(F.col("edited_codes")).alias("edited_fingerprint"), "near_edited", "near_next", "next_id")


def mine(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth vector, a seventh of the labels being wrong on purpose."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(embeddings, F.col("vec_id") % 100 == 0, moved)


@query
def op13_hard_negatives(spark, sf_dir):
    return mine(table(spark, sf_dir, "embeddings"))


_SCALED = """
            WITH kept AS (
                SELECT row_number() OVER () AS r, vec_id, {label} AS label,
                       list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v
                FROM embeddings
                WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
            scored AS (
                SELECT a.r AS ar, b.r AS br, a.vec_id AS asked, b.vec_id AS other, a.label = b.label AS same,
                       CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
                FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.r <> b.r)"""


def all_oracles() -> dict[str, str]:
    return {
        "op3_top_k": _SCALED.format(label="0", scale=1024) + """
            SELECT asked AS query_id, CAST(row_number() OVER (PARTITION BY ar ORDER BY score DESC, other) AS INTEGER) AS rank,
                   other AS vec_id, score
            FROM scored WHERE other IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, other) <= 10""",
        "op13_hard_negatives": _SCALED.format(
            label="CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END", scale=256) + """,
            positives AS (
                SELECT * FROM scored WHERE same
                QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, other) <= 5),
            found AS (
                SELECT p.asked, p.other AS positive_id, p.score AS positive_score, n.other AS negative_id, n.score AS negative_score,
                       row_number() OVER (PARTITION BY p.ar, p.br ORDER BY n.score DESC, n.other) AS rank
                FROM positives p JOIN scored n ON p.ar = n.ar AND NOT n.same
                 AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
            SELECT asked AS anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
            FROM found WHERE rank <= 5""",
        "op8_url_filter": r"""
            WITH rules(h, p, v) AS (
                VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
                       ('org', '/fr/', 'allow')),
            cut AS (
                SELECT row_number() OVER () AS r, page_id,
                       CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
                FROM pages),
            parts AS (
                SELECT r, page_id,
                       translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS host,
                       regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
                FROM cut),
            best AS (
                SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
                FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
                GROUP BY r)
            SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
            FROM parts LEFT JOIN best USING (r)""",
    }
