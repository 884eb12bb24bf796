"""Quality rules with adaptive thresholds.

``base_statistics`` counts five figures on each whole text.  The adaptive
verdict replaces fixed cutoffs: for every language and source, a mergeable
quantile sketch of each ratio (row counts on a fixed grid of per-mille steps,
merged by adding counts, so partial aggregation sees at most 1001 cells a group
and ratio however many rows there are) gives the quartiles, and a text whose
ratio lies beyond an outlier fence of its own group is rejected.  Groups are
smoothed by merging in a scaled copy of the language's sketch and of the
overall one, which lets a small group lean on its parents.  The fences are
joined back to the rows (a table of groups, not of documents).

A group full of junk has junk quartiles, so no fence lies beyond twice the usual one: the median, over the sources of
its language (over all groups, if it has under MIN_SOURCES), each weighing the same, of a fence from the lower half of their
own sketches.  Junk moves it only if it fills half of the rows in half of the sources.

Defined cases: a null or empty text has no words and fails the base rule; null
lang or source form a group of their own; repeated rows are judged alike, each
returned; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.textkit import _SPACE, as_batches, hash_words, mix, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
STEPS = 1000                 # grid of the sketch: per mille
PRIOR_ROWS = 200             # weight of each parent sketch merged into a group's own
SPREADS = 6                  # fence: third quartile plus this many interquartile ranges
MIN_SOURCES = 3              # fewer sources of a language say nothing of what is usual in it
CAP = 2                      # times the usual fence
SLACK = {"symbols": 20, "dup_lines": 300, "repeats": 400}    # least distance of a fence above the third quartile, per mille

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_STATS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
                    ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64())])


def _sum(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def _repeated(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries that occur more than once in their document, entries that equal an earlier one)."""
    order = np.lexsort((key, doc))                     # stable: equal keys stay in text order
    k, d = key[order], doc[order]
    same = np.zeros(len(k), dtype=bool)
    same[1:] = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    again = same.copy()
    again[:-1] |= same[1:]
    many, later = np.empty(len(k), dtype=bool), np.empty(len(k), dtype=bool)
    many[order], later[order] = again, same
    return many, later


def _statistics(rows: pa.RecordBatch, data: np.ndarray, off: np.ndarray) -> list:
    starts, ends, first = words(data, off)
    n = np.diff(first)
    h = hash_words(data, starts, ends)
    doc = np.repeat(np.arange(len(n)), n)
    leads = (data & 0xC0) != 0x80                      # one per code point
    chars = _sum(leads & ~_SPACE[data], off)
    symbols = _sum(_SYMBOL[data], off)
    # three-word windows inside one document
    hit = np.zeros(len(h) + 3, dtype=bool)
    if len(h) > 2:
        inner = np.flatnonzero(doc[2:] == doc[:-2])
        m2 = np.uint64(0x94D049BB133111EB)
        tri = mix(mix(h[inner] * m2 + h[inner + 1]) * m2 + h[inner + 2])
        many, _ = _repeated(tri, doc[inner])
        at = inner[many]
        for j in range(3):
            hit[at + j] = True
    repeats = _sum(hit[:len(h)], first)
    # lines holding a word, compared byte for byte through a 64-bit hash
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:] = data == 10 if len(data) else False
    cut[off[:-1]] = True
    cut[len(data)] = False
    begin = np.flatnonzero(cut[:len(data)]) if len(data) else np.zeros(0, np.int64)
    line_doc = np.searchsorted(off, begin, "right") - 1
    limit = np.minimum(np.append(begin[1:], len(data)), off[line_doc + 1]) if len(begin) else begin
    stop = np.where((limit > begin) & (data[np.maximum(limit - 1, 0)] == 10), limit - 1, limit) if len(begin) else begin
    filled = np.searchsorted(starts, stop) > np.searchsorted(starts, begin)
    begin, stop, line_doc = begin[filled], stop[filled], line_doc[filled]
    _, later = _repeated(hash_words(data, begin, stop), line_doc)
    dup = np.bincount(line_doc[later], minlength=len(n)).astype(np.int64)
    return [rows.column(0), n.astype(np.int64), chars, symbols, dup, repeats]


def _task(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return as_batches(iterator, _statistics, _STATS)


def base_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the five counts and ``base_failed``, one row per input row."""
    lang, source = ((F.col(c) if c in docs.columns else F.lit(None)).cast("string").alias(c) for c in ("lang", "source"))
    schema = pa.schema([*_STATS, ("lang", pa.string()), ("source", pa.string())])

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return as_batches(it, lambda r, d, o: [*_statistics(r, d, o), r.column(2), r.column(3)], schema)

    out = docs.select(F.col("doc_id").cast("bigint"), "text", lang, source).mapInArrow(
        task, "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, lang string, source string")
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _grid() -> dict[str, Column]:
    """Each ratio as a whole number of per mille, 0 to STEPS."""
    def share(a: str, b: str) -> Column:
        return F.least(F.lit(STEPS), F.expr(f"coalesce({STEPS} * {a} div nullif({b}, 0), 0)")).cast("int")
    return {"symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines * 10", "n_words"),
            "repeats": share("n_repeat_words", "n_words")}


def sketches(stats: DataFrame) -> DataFrame:
    """(lang, source, ratio, step, n): the quantile sketch of every group.

    Two sketches merge by adding ``n`` of equal steps."""
    cells = F.inline(F.array(*[F.struct(F.lit(k).alias("ratio"), v.alias("step")) for k, v in _grid().items()]))
    return (stats.filter(~F.col("base_failed")).select("lang", "source", cells)
            .groupBy("lang", "source", "ratio", "step").agg(F.count("*").alias("n")))


def _scaled(cells: DataFrame, keys: list[str]) -> DataFrame:
    """A sketch per ``keys``, scaled to PRIOR_ROWS rows."""
    one = cells.groupBy(*keys, "ratio", "step").agg(F.sum("n").alias("n"))
    total = one.groupBy(*[F.col(k).alias(f"t_{k}") for k in [*keys, "ratio"]]).agg(F.sum("n").alias("all_n"))
    same = F.lit(True)
    for k in [*keys, "ratio"]:
        same = same & F.col(k).eqNullSafe(F.col(f"t_{k}"))
    return one.join(total, same).select(*keys, "ratio", "step", (F.lit(PRIOR_ROWS) * F.col("n") / F.col("all_n")).alias("n"))


def _slack() -> Column:
    slack = F.lit(0)
    for k, v in SLACK.items():
        slack = F.when(F.col("ratio") == k, F.lit(v)).otherwise(slack)
    return slack


def _quantiles(cells: DataFrame, **shares: float) -> DataFrame:
    """A row per (lang, source, ratio) with the steps at the given shares of its rows."""
    w = Window.partitionBy("lang", "source", "ratio")
    upto = F.sum("n").over(w.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("n").over(w)
    return (cells.withColumn("upto", F.round(upto, 9)).groupBy("lang", "source", "ratio")
            .agg(*[F.min(F.when(F.col("upto") >= v, F.col("step"))).alias(k) for k, v in shares.items()]))


def caps(cells: DataFrame) -> DataFrame:
    """(lang, ratio, cap) from sketches: CAP times the median of the sources' fences, each from the lower half of its own sketch."""
    lower = _quantiles(cells, q1=0.25, q2=0.5).withColumn("usual", F.col("q2") + F.greatest(2 * SPREADS * (F.col("q2") - F.col("q1")), _slack()))
    median = F.expr("percentile_disc(0.5) within group (order by usual)").cast("int")
    by_lang = lower.groupBy("lang", "ratio").agg(F.count("*").alias("sources"), median.alias("usual"))
    overall = lower.groupBy(F.col("ratio").alias("r")).agg(median.alias("any_usual"))
    return (by_lang.join(overall, F.col("ratio") == F.col("r"))
            .select("lang", "ratio", (CAP * F.when(F.col("sources") >= MIN_SOURCES, F.col("usual")).otherwise(F.col("any_usual"))).alias("cap")))


def fences(cells: DataFrame) -> DataFrame:
    """(lang, source, ratio, fence) from sketches: third quartile plus the larger of
    SPREADS interquartile ranges and the ratio's least slack, at most the language's cap."""
    groups = cells.select("lang", "source", "ratio").distinct()
    by_lang, overall = _scaled(cells, ["lang"]), _scaled(cells, [])
    g1 = groups.join(by_lang.withColumnRenamed("lang", "l").withColumnRenamed("ratio", "r"),
                     F.col("lang").eqNullSafe(F.col("l")) & (F.col("ratio") == F.col("r"))).select("lang", "source", "ratio", "step", "n")
    g2 = groups.join(overall, "ratio").select("lang", "source", "ratio", "step", "n")
    merged = (cells.select("lang", "source", "ratio", "step", F.col("n").cast("double").alias("n")).unionByName(g1).unionByName(g2)
              .groupBy("lang", "source", "ratio", "step").agg(F.sum("n").alias("n")))
    most = caps(cells).withColumnsRenamed({"lang": "c_lang", "ratio": "c_ratio"})
    return (_quantiles(merged, q1=0.25, q3=0.75).join(most, F.col("lang").eqNullSafe(F.col("c_lang")) & (F.col("ratio") == F.col("c_ratio")))
            .select("lang", "source", "ratio",
                    F.least(F.col("q3") + F.greatest(SPREADS * (F.col("q3") - F.col("q1")), _slack()), F.col("cap")).alias("fence")))


def judge(docs: DataFrame) -> DataFrame:
    """Statistics of every row, ``base_failed``, the group's fences and ``kept``."""
    from lakeward.llm.textkit import stored

    stats = stored(base_statistics(docs), "quality-stats")
    wide = (fences(sketches(stats)).groupBy(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"))
            .agg(*[F.max(F.when(F.col("ratio") == k, F.col("fence"))).alias(f"max_{k}") for k in SLACK]))
    out = stats.join(wide, stats["lang"].eqNullSafe(wide["g_lang"]) & stats["source"].eqNullSafe(wide["g_source"]), "left").drop("g_lang", "g_source")
    inside = F.lit(True)
    for k, v in _grid().items():
        inside = inside & F.coalesce(v <= F.col(f"max_{k}"), F.lit(True))
    return out.withColumn("kept", ~F.col("base_failed") & inside)
