"""URL rules through a Bloom filter cascade, on DataFrame functions alone.

The listed keys are rules ``host + path prefix``.  Every url offers one
candidate key per shape (number of host labels, path length) that the list
holds; the candidates of all urls are the key universe.  Level 0 of a cascade
is a Bloom filter over the listed keys, level 1 one over the universe keys that
level 0 lets through wrongly, level 2 one over the listed keys that level 1
lets through, and so on until a level lets nothing through wrongly.  A
universe key is listed if the first level that rejects it has an odd number
(or no level rejects it and the last is even), so urls are judged exactly and without a join.

Sizes follow the list, not the corpus: with p0 about listed/universe the
first false positives are as many as the listed keys, whatever the number of urls.
A list above ``max_keys`` is not turned into a driver-built filter; it is joined by key instead.

Defined cases: a null url or one without ``://`` has empty host and path and
fits no rule; an empty list allows everything; rules given twice count once and
if one key is both allowed and blocked, block wins; repeated pages are each
returned; extra columns stay untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.textkit import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_KEYS = 1_000_000         # listed keys in driver-built filters: about 4 MB
MAX_LEVELS = 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a url as the contract cuts them."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def _key(host: Column, path: Column, labels: int, length: int) -> Column:
    return F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, length))


def _candidates(shapes: list[tuple[int, int]]) -> Column:
    return F.array(*[_key(F.col("host"), F.col("path"), a, b) for a, b in shapes])


class Level:
    """One Bloom filter: 64-bit words, the bit position taken from double hashing."""

    def __init__(self, bits: int, hashes: int, seed: int, words: list[int]):
        self.bits, self.hashes, self.seed, self.words = bits, hashes, seed, words

    @staticmethod
    def positions(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
        a = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits))
        b = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(bits - 1)) + 1
        return [F.pmod(a + F.lit(i) * b, F.lit(bits)) for i in range(hashes)]

    def holds(self, key: Column) -> Column:
        # one foldable string literal becomes a constant array: no per-word py4j call
        table = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        test = F.lit(True)
        for p in self.positions(key, self.bits, self.hashes, self.seed):
            word = F.element_at(table, (F.shiftright(p, 6) + 1).cast("int"))
            test = test & (F.getbit(word, p.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return test

    @classmethod
    def build(cls, keys: DataFrame, n: int, p: float, seed: int) -> "Level":
        """``keys`` has one column ``key``; the bit words are merged by OR before they reach the driver."""
        bits = max(64, 64 * math.ceil(max(n, 1) * -math.log(p) / math.log(2) ** 2 / 64))
        hashes = max(1, round(bits / max(n, 1) * math.log(2))) if n else 1
        hashes = min(hashes, max(1, math.ceil(-math.log2(p))))
        pos = F.explode(F.array(*cls.positions(F.col("key"), bits, hashes, seed)))
        one = F.expr("shiftleft(1L, cast(pos & 63 as int))")
        got = (keys.select(pos.alias("pos")).groupBy(F.shiftright("pos", 6).alias("at"))
               .agg(F.bit_or(one).alias("word")).collect())
        words = [0] * (bits // 64)
        for r in got:
            words[r["at"]] = r["word"]
        return cls(bits, hashes, seed, words)


def build_cascade(listed: DataFrame, n_listed: int, universe: DataFrame, n_universe: int, seed: int = 17) -> list[Level]:
    """``listed`` and ``universe`` have one column ``key``; both may repeat keys."""
    if not n_listed:
        return []
    first = min(0.5, max(n_listed, 1) / (math.sqrt(2) * max(n_universe, 1)))
    levels = [Level.build(listed, n_listed, first, seed)]
    wrong = stored(universe.filter(levels[0].holds(F.col("key"))).distinct()
                   .join(listed.distinct(), "key", "left_anti"), "cascade-wrong")
    right = listed.distinct()
    n = wrong.count()
    while n:
        if len(levels) >= MAX_LEVELS:
            raise RuntimeError("cascade does not converge")
        levels.append(Level.build(wrong, n, 0.5, seed + len(levels)))
        wrong, right = stored(right.filter(levels[-1].holds(F.col("key"))), "cascade-wrong"), wrong
        n = wrong.count()
    return levels


def listed_by(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed: the first rejecting level decides."""
    out = F.lit(len(levels) % 2 == 1)
    for i in range(len(levels) - 1, -1, -1):
        out = F.when(~levels[i].holds(key), F.lit(i % 2 == 1)).otherwise(out)
    return out


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", max_keys: int = MAX_KEYS) -> DataFrame:
    """Add host, path, rule and verdict to every row of ``pages``.

    ``rules`` has host, path and verdict (allow or block).  The longest fitting rule
    decides; a url that fits none is not listed and allowed."""
    own = (rules.groupBy(F.concat("host", "path").alias("key"))
           .agg(F.max("verdict").alias("verdict"), F.max(F.size(F.split("host", r"\."))).alias("labels"), F.max(F.length("path")).alias("length")))
    own = stored(own, "url-rules")
    shapes = [(r[0], r[1]) for r in own.select("labels", "length").distinct().orderBy("labels", "length").collect()]
    counts = {r[0]: r[1] for r in own.groupBy("verdict").count().collect()}
    host, path = host_and_path(F.col(url))
    out = pages.withColumns({"host": host, "path": path})
    if not shapes:
        return out.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    if sum(counts.values()) > max_keys:
        return _joined(out, own, shapes)
    universe = pages.select(host.alias("host"), path.alias("path")).select(F.explode(_candidates(shapes)).alias("key"))
    n_universe = universe.agg(F.approx_count_distinct("key")).first()[0]
    cascades = {v: build_cascade(own.filter(F.col("verdict") == v).select("key"), counts.get(v, 0), universe, n_universe,
                                 17 if v == "allow" else 1017) for v in ("allow", "block")}
    # a column of the fitting rule per shape, then the longest; of equal length they are one key, which has one verdict
    hits = {}
    for i, (a, b) in enumerate(shapes):
        key = _key(F.col("host"), F.col("path"), a, b)
        kind = F.lit(None).cast("string")
        for v, levels in cascades.items():
            if levels:
                kind = F.when(listed_by(levels, key), F.lit(v)).otherwise(kind)
        hits[f"_kind{i}"] = kind
    out = out.withColumns(hits)
    best = F.array_max(F.array(*[F.when(F.col(f"_kind{i}").isNotNull(), F.struct(
        F.length(_key(F.col("host"), F.col("path"), a, b)).alias("n"), _key(F.col("host"), F.col("path"), a, b).alias("k"), F.col(f"_kind{i}").alias("v")))
        for i, (a, b) in enumerate(shapes)]))
    return (out.withColumn("_best", best).withColumns({"rule": F.col("_best.k"), "verdict": F.coalesce("_best.v", F.lit("allow"))})
            .drop("_best", *hits))


def _joined(out: DataFrame, own: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """For lists too long for a filter on the driver: one equi-join a shape."""
    for i, (a, b) in enumerate(shapes):
        side = own.select(F.col("key").alias(f"_k{i}"), F.col("verdict").alias(f"_v{i}"))
        out = out.join(side, _key(F.col("host"), F.col("path"), a, b) == side[f"_k{i}"], "left")
    best = F.sort_array(F.array(*[F.struct(F.coalesce(F.length(f"_k{i}"), F.lit(-1)).alias("n"), F.col(f"_k{i}").alias("k"), F.col(f"_v{i}").alias("v"))
                                  for i in range(len(shapes))]), False)[0]
    drop = [f"_{x}{i}" for i in range(len(shapes)) for x in "kv"]
    return out.withColumns({"rule": best["k"], "verdict": F.coalesce(best["v"], F.lit("allow"))}).drop(*drop)
