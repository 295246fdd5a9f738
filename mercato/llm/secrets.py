"""Secret scan: candidates in each text, judged by how many owners hold the same value across the whole corpus.

A value that many repositories of many owners hold is a copied example; one that a single owner holds looks live.
Only hashes of values are aggregated: first to distinct (hash, owner, repository), which a hot value cannot swell,
then to counts per hash.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import map_values
from mercato.session import materialise

KINDS = ("assign", "access", "hex", "key", "other")
BASE_KINDS = KINDS[:3]
# fixed values: patterns of the base kinds
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_KEY = re.compile(
    r"gh[pousr]_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{16,}|-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", re.A)
# from the start of its run of signs to the first place that can begin a token, so that no run is read from many places
_WEB_TOKEN = re.compile(r"(?<![\w-])(?:(?!eyJ)[\w-])*+(?P<key>eyJ[\w-]{8,}+\.eyJ[\w-]{8,}+\.[\w-]{8,}+)", re.A)
_OTHER = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}+={0,2}+(?![A-Za-z0-9+/_=-])")
_LETTER, _DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")
LEAST_ENTROPY = 3.5  # bits a character, for values that only their look gives away
MOST_OWNERS = 1  # holders up to which a value looks live

Found = tuple[str, int, int, str]


def _entropy(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def _looks_random(value: str) -> bool:
    return bool(_LETTER.search(value) and _DIGIT.search(value)) and _entropy(value) >= LEAST_ENTROPY


def _apart(new: list[Found], taken: list[Found]) -> list[Found]:
    """Those of ``new`` that overlap nothing of ``taken``."""
    spans = sorted((a, b) for _, a, b, _ in taken)
    starts, ends = [a for a, _ in spans], list(accumulate((b for _, b in spans), max))
    return [f for f in new if not (before := bisect_left(starts, f[2])) or ends[before - 1] <= f[1]]


def candidates(text: str | None) -> list[Found]:
    """(kind, start, end, value), by start, then kind; base kinds always, the others where they overlap none of these.

    Time grows with the text's length, whatever it holds.
    """
    if not text:
        return []
    found = [("assign", *m.span(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", *m.span(), m[0]) for m in _HEX.finditer(text)]
    keys = [("key", *m.span(), m[0]) for m in _KEY.finditer(text)]
    if "eyJ" in text:
        keys += [("key", *m.span("key"), m["key"]) for m in _WEB_TOKEN.finditer(text)]
    found += _apart(keys, found)
    others = [("other", *m.span(), m[0]) for m in _OTHER.finditer(text) if _looks_random(m[0])]
    found += _apart(others, found)
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


def _scan(text: str | None) -> list[dict]:
    return [
        {"kind": k, "start": a, "end": b, "value": hashlib.blake2b(v.encode(), digest_size=16).hexdigest()}
        for k, a, b, v in candidates(text)]


SCANNED = "array<struct<kind:string,start:int,end:int,value:string>>"


def find_secrets(
    docs: DataFrame, keep: list[str], text_col: str, owner: Column, repository: Column, most_owners: int = MOST_OWNERS,
) -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, with ``secrets``: an array by start, then kind, of
    (kind, start, end, owners, repositories, live).

    Base kinds are always listed; the others only if live, that is held by at most ``most_owners`` owners. Start and
    end are code points. A null or empty text has none; a null owner or repository counts as one of its own. Repeated
    rows are each listed, and add neither owners nor repositories. Empty tables give no rows; no column of ``docs``
    besides ``keep`` is carried, and one named ``secrets`` is replaced.
    """
    kept = [c for c in keep if c != "secrets"]
    scanned = docs.select(
        F.struct(*kept).alias("kept"), owner.alias("owner"), repository.alias("repository"),
        map_values(_scan, SCANNED, F.col(text_col)).alias("found"))
    scanned = materialise(
        scanned.withColumn("row", F.monotonically_increasing_id()), "secrets")  # numbers settle when written
    hits = scanned.select("row", "owner", "repository", F.explode("found").alias("f"))
    no_one = F.lit("\u0000")
    holders = (
        hits.select(
            F.col("f.value").alias("value"), F.coalesce("owner", no_one).alias("owner"),
            F.coalesce("repository", no_one).alias("repository")).distinct()
        .groupBy("value", "owner").agg(F.count("*").alias("repositories"))
        .groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    )
    holders = materialise(holders, "secret-holders")
    base = F.col("f.kind").isin(*BASE_KINDS)
    judged = (
        hits.select("row", "f").join(holders, F.col("f.value") == F.col("value"))
        .withColumn("live", F.col("owners") <= most_owners).filter(base | F.col("live"))
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
            F.col("f.start").alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), F.col("f.kind")).alias("place"),
            F.col("f.end").alias("end"), F.col("f.kind").alias("kind"), "owners", "repositories", "live"))).alias("s"))
    )
    secrets = F.expr(
        "transform(coalesce(s, array()), x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end, "
        "'owners', x.owners, 'repositories', x.repositories, 'live', x.live))")
    return scanned.select("row", "kept").join(judged, "row", "left").select("kept.*", secrets.alias("secrets"))
