"""URL filters: path rules first, then a cascade of Bloom filters over hosts.

The cascade holds a set of listed keys exactly, given the complete universe of keys of
the corpus. Level 1 encodes the listed keys; level 2 the unlisted keys that level 1
wrongly contains; level 3 the listed keys that level 2 wrongly contains, and so on,
until a level has no false positive. A key belongs to the list if the first level that
lacks it is an even one. Pages are judged by hashes of their host, so no join is needed.
"""

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from .shared import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rules (verdict, host, path); the longest that fits wins.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def rule(host_: Column, path_: Column, rules=RULES) -> Column:
    """(verdict, rule) of the longest fitting rule, or NULL. A rule fits its host and all subdomains."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, domain, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == domain) | host_.endswith("." + domain)) & path_.startswith(start)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(domain + start).alias("rule"))).otherwise(out)
    return out


def _slots(first: np.ndarray, second: np.ndarray, level: int, hashes: int, bits: int) -> np.ndarray:
    """Bit positions of keys (two 64-bit hashes each) in a level: hashes x keys."""
    with np.errstate(over="ignore"):
        a = (first ^ np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
        b = (second + np.uint64(level)) * np.uint64(0xC2B2AE3D27D4EB4F) | np.uint64(1)
        return np.stack([((a + np.uint64(i) * b) >> np.uint64(11)) % np.uint64(bits) for i in range(hashes)])


def _has(words: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return ((words[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1)).astype(bool).all(axis=0)


@dataclass(frozen=True)
class Cascade:
    """Levels of (hash functions, bits, words of 64 bits)."""

    levels: tuple

    @property
    def size(self) -> int:
        return sum(words.nbytes for _, _, words in self.levels)

    def listed(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether keys of the universe are listed, from their two hashes as signed longs."""
        first, second = first.view(np.uint64), second.view(np.uint64)
        out = np.zeros(len(first), bool)
        open_ = np.arange(len(first))
        for level, (hashes, bits, words) in enumerate(self.levels, 1):
            inside = _has(words, _slots(first[open_], second[open_], level, hashes, bits))
            out[open_[~inside]] = level % 2 == 0
            out[open_[inside]] = level % 2 == 1  # in all levels: a member of the last
            open_ = open_[inside]
        return out


def hashes(key: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes."""
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


def build(universe: DataFrame, key: str, listed: str, max_bytes: int = 64 << 20) -> Cascade:
    """A cascade over distinct keys, of which those with `listed` true are on the list.

    NULL keys are left out. Each level is built by tasks that set bits for their share of
    the keys; Spark combines equal words, and the driver gets the words of one level. The
    cascade takes some ten bits per listed key; beyond `max_bytes` the build stops with an
    error, as it is sent to every task. Without listed keys the cascade has no level.
    """
    first, second = hashes(F.col(key))
    current = stored(universe.where(F.col(key).isNotNull()).select(
        first.alias("a"), second.alias("b"), F.coalesce(F.col(listed), F.lit(False)).alias("side")))
    levels: list[tuple] = []
    sides = {row["side"]: row["count"] for row in current.groupBy("side").count().collect()}
    inside, outside = sides.get(True, 0), sides.get(False, 0)
    total = 0
    while inside:
        level = len(levels) + 1
        # The first level lets about as many others pass as there are members, later ones a sixteenth.
        rate = min(0.5, max(inside / max(outside, 1), 2.0**-16)) if level == 1 else 1 / 16
        count = max(1, round(-np.log2(rate)))
        bits = max(64, int(np.ceil(inside * count / np.log(2) / 64)) * 64)
        total += bits // 8
        if total > max_bytes:
            raise ValueError(f"the cascade needs over {max_bytes} bytes; raise max_bytes")
        member = level % 2 == 1

        def set_bits(batches: Iterator[pd.DataFrame], level=level, count=count, bits=bits) -> Iterator[pd.DataFrame]:
            words = np.zeros(bits // 64, np.uint64)
            for batch in batches:
                slots = _slots(batch["a"].to_numpy(np.int64).view(np.uint64), batch["b"].to_numpy(np.int64).view(np.uint64), level, count, bits).ravel()
                np.bitwise_or.at(words, slots >> np.uint64(6), np.uint64(1) << (slots & np.uint64(63)))
            there = np.flatnonzero(words)
            yield pd.DataFrame({"place": there, "word": words[there].view(np.int64)})

        rows = current.where(F.col("side") == member).select("a", "b").mapInPandas(set_bits, "place long, word long").groupBy(
            "place").agg(F.bit_or("word").alias("word")).toPandas()
        words = np.zeros(bits // 64, np.uint64)
        words[rows["place"].to_numpy()] = rows["word"].to_numpy(np.int64).view(np.uint64)
        levels.append((count, bits, words))
        shared = current.sparkSession.sparkContext.broadcast(levels[-1])

        def passes(batches: Iterator[pd.DataFrame], level=level, shared=shared) -> Iterator[pd.DataFrame]:
            count, bits, words = shared.value
            for batch in batches:
                slots = _slots(batch["a"].to_numpy(np.int64).view(np.uint64), batch["b"].to_numpy(np.int64).view(np.uint64), level, count, bits)
                yield batch[_has(words, slots)]

        # Members of this level stay as the other side's background; wrongly contained keys come next.
        wrong = current.where(F.col("side") != member).mapInPandas(passes, current.schema)
        current = stored(current.where(F.col("side") == member).union(wrong))
        inside = current.where(F.col("side") != member).count()
        if level > 200:
            raise ValueError("two keys have equal hashes")
    return Cascade(tuple(levels))


def on_list(frame: DataFrame, cascade: Cascade, key: str, name: str = "listed") -> DataFrame:
    """Adds whether the key is on the list; keys must come from the universe, NULL is not listed."""
    if not cascade.levels:
        return frame.withColumn(name, F.lit(False))
    shared = frame.sparkSession.sparkContext.broadcast(cascade)  # at most max_bytes, checked by build

    @F.pandas_udf("boolean")
    def look(first: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series(shared.value.listed(first.to_numpy(np.int64), second.to_numpy(np.int64)))

    first, second = hashes(F.col(key))
    return frame.withColumn(name, F.col(key).isNotNull() & look(first, second))


def mostly_blocked_hosts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Every host of the corpus with `listed`: rules block over half of those of its pages that a rule decides."""
    ruled = pages.select(host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    ruled = ruled.select("host", rule(F.col("host"), F.col("path"))["verdict"].alias("v"))
    blocked, decided = F.count(F.when(F.col("v") == "block", 1)), F.count("v")
    return ruled.groupBy("host").agg((2 * blocked > decided).alias("listed")).where("host <> ''")


def judged(pages: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict for every page.

    A rule's verdict stands; other pages are blocked if their host is mostly blocked, read
    from the cascade. Urls that are NULL or lack `://` have no host and are allowed.
    Repeated rows are each judged; an empty table gives no row.
    """
    cascade = build(mostly_blocked_hosts(pages, url), "host", "listed")
    rows = pages.select(F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    ruled = on_list(rows, cascade, "host").withColumn("r", rule(F.col("host"), F.col("path")))
    return ruled.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce(
        "r.verdict", F.when(F.col("listed") & (F.col("host") != ""), "block").otherwise("allow")).alias("verdict"))


JUDGED_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parts),
told AS (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS ruled_verdict
  FROM ruled),
hosts AS (
  SELECT host FROM told WHERE host <> '' GROUP BY host
  HAVING 2 * count(CASE WHEN ruled_verdict = 'block' THEN 1 END) > count(ruled_verdict))
SELECT page_id, host, path, rule,
       coalesce(ruled_verdict, CASE WHEN host IN (SELECT host FROM hosts) THEN 'block' ELSE 'allow' END) AS verdict
FROM told
"""
