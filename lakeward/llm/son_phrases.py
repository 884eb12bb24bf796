"""Phrase collocations by partitioned mining (SON).

A phrase that occurs ``support`` times in a language occurs, in at least one shard of its documents, at least
``support`` times that shard's share of the words (rounded up): shards each short of that by one would add up to less.

1. Documents are dealt into a few shards.  Every shard is mined completely at its lowered support, level by level:
   words, pairs of frequent words, then runs of three and four whose pairs are all frequent.
   Shards are keys, not tasks: each level is one aggregation over (lang, shard, phrase), so a shard of any size is
   spread over all executors, and repeats are counted within tasks before they are shuffled.
   A shard that has counted a phrase knows all its occurrences there, and one that has not holds less than its lowered support,
   so a phrase whose counts and bounds add up to less than the support is dropped at its level, in all shards.
2. The phrases frequent in some shard are united, and one pass counts them in the shards that have not, and reads their texts:
   each from the documents of the lowest slot that holds it, so a phrase's row comes from about one task, not from all of them.

What a level found frequent reaches the next pass as a bloom filter of fixed size.  A false positive only
costs a count; it changes no result, since a phrase's counts are taken from the shards by its hash and the support decides.
Fewer shards mean a higher local support and less to shuffle; beyond ``support`` shards the local support is 1 and prunes nothing.

Scores, cuts and the removal of contained phrases are joins and aggregates over the frequent phrases; products are decimals.

Defined cases: a null lang is ``und``; a null or empty text has no words; null doc_ids and repeated rows count like any row; extra columns are
ignored; an empty table gives an empty result.  A phrase is counted by the 64-bit hash of its language and words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.textkit import _A, _M2, hash_words, lower_ascii, mix, signed, slices, stored, words

SUPPORT, LONGEST = 30, 4
SHARDS = 3
SLOTS = 1 << 14              # of a shard's documents; the lowest one with a phrase gives its text
CONTAINED = 80               # percent of a phrase's occurrences from which a longer one around it replaces it
TOP = 2000
SCORE = "(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + r)"
FILTER_BITS = 1 << 26        # of the phrases found frequent at a level: 8 MB, whatever their number
WANTED_TIMES = 4             # the filter of what the last pass sends on is up to so many times as large, where phrases are many
HELD = 1 << 20               # phrases counted in a task before they are sent on

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_SEPARATOR = _BREAK.copy()
_SEPARATOR[[9, 32]] = True


class Filter:
    """Bloom filter over phrase hashes, built by ORs in Spark."""

    def __init__(self, found: DataFrame, salted: bool, times: int = 1):
        """``found``: gram and, where ``salted``, the shard in which it is frequent; ``times``: of FILTER_BITS, a power of two."""
        mask = np.uint64(FILTER_BITS * times - 1)

        def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in it:
                h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                h = mix(h + batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint64) * _A if salted else h)
                x = np.concatenate([h & mask, (h >> np.uint64(32)) & mask])
                yield pa.RecordBatch.from_arrays([pa.array((x >> np.uint64(6)).astype(np.int64)), pa.array(signed(np.uint64(1) << (x & np.uint64(63))))], ["place", "bits"])

        self.bits = np.zeros(FILTER_BITS * times // 64, dtype=np.uint64)
        got = found.select("gram", "shard").mapInArrow(task, "place bigint, bits bigint").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
        self.bits[got["place"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)


def _holds(bits: np.ndarray, gram: np.ndarray, shard: np.ndarray | None) -> np.ndarray:
    """Whether the filter may hold each gram (of its shard)."""
    mask, low = np.uint64(len(bits) * 64 - 1), np.uint64(63)
    h = mix(gram if shard is None else gram + shard.astype(np.uint64) * _A)
    x, y = h & mask, (h >> np.uint64(32)) & mask
    return ((bits[x >> np.uint64(6)] >> (x & low) & bits[y >> np.uint64(6)] >> (y & low)) & np.uint64(1)).astype(bool)


class Run:
    """The words of a slice: hashes that know their language, and which neighbours stand in one piece."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lang: np.ndarray):
        """``lang``: a hash per document."""
        data = lower_ascii(data)
        self.data = data
        self.starts, self.ends, first = words(data, off, _SEPARATOR)
        per = np.diff(first)
        self.doc = np.repeat(np.arange(len(per)), per)
        h = hash_words(data, self.starts, self.ends)
        seen = np.zeros(len(data) + 1, dtype=np.int32)
        np.cumsum(_BREAK[data], out=seen[1:])
        self.next = (self.doc[1:] == self.doc[:-1]) & (seen[self.starts[1:]] == seen[self.ends[:-1]])
        self.grams, self.at = [mix(h * _M2 + lang[self.doc])], [np.arange(len(h))]     # of one word, two ...; their first words
        self.word = h

    def longer(self, keep: np.ndarray) -> None:
        """Adds the grams one word longer than the last ones, at the last one's places in ``keep`` whose next word is in the same piece."""
        k, gram, at = len(self.grams), self.grams[-1][keep], self.at[-1][keep]
        inside = at + k < len(self.word)
        gram, at = gram[inside], at[inside]
        inside = self.next[at + k - 1]
        gram, at = gram[inside], at[inside]
        self.at.append(at)
        self.grams.append(mix(gram * _M2 + self.word[at + k]))


    def spaced(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with one space after each, and where each begins (one more entry than words)."""
        word = np.zeros(len(self.word) + 1, dtype=np.int64)
        np.cumsum(self.ends - self.starts + 1, out=word[1:])
        out = np.full(word[-1], 32, dtype=np.uint8)
        inside = np.ones(word[-1], dtype=bool)
        inside[word[1:] - 1] = False
        out[inside] = self.data[~_SEPARATOR[self.data]]
        return out, word


def _lang_hash(lang: pa.Array, known: dict[str, int]) -> np.ndarray:
    names = lang.dictionary_encode()
    for name in names.dictionary.to_pylist():
        if name not in known:
            raw = np.frombuffer(name.encode(), dtype=np.uint8)
            known[name] = int(mix(hash_words(raw, np.zeros(1, np.int64), np.full(1, len(raw), np.int64)) ^ _A)[0])
    return np.array([known[x] for x in names.dictionary.to_pylist()], dtype=np.uint64)[names.indices.to_numpy()]


_LOCAL = pa.schema([("lang", pa.string()), ("slot", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])


def _levels(run: Run, shard: np.ndarray, level: int, bits: np.ndarray | None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Grams to be counted at a level, with their first words: words, pairs of frequent words, or runs of frequent pairs."""
    if level == 1:
        return [(run.grams[0], run.at[0])]
    own = shard[run.doc]
    good = _holds(bits, run.grams[0], own) if level == 2 else None
    run.longer(slice(None))
    gram, at = run.grams[1], run.at[1]
    if level == 2:
        both = good[at] & good[at + 1]
        return [(gram[both], at[both])]
    pair = np.zeros(len(run.word) + LONGEST, dtype=bool)          # whether a frequent pair begins at the word
    pair[at] = _holds(bits, gram, own[at])
    out, follows = [], pair[at]
    for k in range(3, LONGEST + 1):
        run.longer(follows)
        at = run.at[-1]
        follows = pair[at + k - 2]
        out.append((run.grams[-1][follows], at[follows]))
    return out


def _local(level: int, bits: np.ndarray | None):
    """Counts of a level's grams within a task: (lang, slot, gram, n), a gram's rows of a shard merged as far as a bounded table reaches."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        names: list[str] = []
        place: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []      # gram, group (language and shard), count, lowest slot

        def merged():
            gram, group, n, slot = (np.concatenate([h[i] for h in held]) for i in range(4))
            order = np.lexsort((gram, group))
            gram, group, n, slot = gram[order], group[order], n[order], slot[order]
            new = np.ones(len(gram), dtype=bool)
            new[1:] = (gram[1:] != gram[:-1]) | (group[1:] != group[:-1])
            head = np.flatnonzero(new)
            held[:] = [(gram[head], group[head], np.add.reduceat(n, head), np.minimum.reduceat(slot, head)) if len(head) else (gram, group, n, slot)]

        def sent():
            gram, group, n, slot = held.pop()
            dictionary = pa.DictionaryArray.from_arrays(pa.array((group // SHARDS).astype(np.int32)), pa.array(names, pa.string())).cast(pa.string())
            for at in range(0, len(gram), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([dictionary[part], pa.array(slot[part]), pa.array(signed(gram[part])), pa.array(n[part])], schema=_LOCAL)

        waiting = 0
        for batch in it:
            for rows, data, off in slices(batch):
                lang = rows.column(0)
                run = Run(data, off, _lang_hash(lang, known))
                slot = rows.column(1).to_numpy(zero_copy_only=False)
                shard = slot % SHARDS
                for name in lang.unique().to_pylist():
                    if name not in place:
                        place[name] = len(names)
                        names.append(name)
                codes = lang.dictionary_encode()
                doc_group = np.array([place[x] for x in codes.dictionary.to_pylist()], dtype=np.int64)[codes.indices.to_numpy()] * SHARDS + shard
                for gram, at in _levels(run, shard, level, bits):
                    held.append((gram, doc_group[run.doc[at]], np.ones(len(gram), dtype=np.int64), slot[run.doc[at]]))
                    waiting += len(gram)
                if waiting > HELD:
                    merged()
                    waiting = len(held[0][0])
                    if 2 * waiting > HELD:
                        yield from sent()
                        waiting = 0
        if held:
            merged()
            yield from sent()

    return task


_COUNT = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("phrase", pa.string()), ("k", pa.int32()), ("shard", pa.int32()), ("n", pa.int64())])


class Strings:
    """Phrases of a task by shard, each with its text once: parallel arrays ordered by a key of gram and shard, and the texts appended to one buffer."""

    def __init__(self):
        self.key, self.n, self.gram = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        self.lang, self.k, self.shard = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.text, self.at, self.size = bytearray(), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def add(self, key: np.ndarray, n: np.ndarray, gram: np.ndarray, lang: np.ndarray, k: np.ndarray, shard: np.ndarray, text: np.ndarray, at: np.ndarray, size: np.ndarray) -> None:
        """Distinct keys in order with their counts; the texts stand in ``text``."""
        place = np.searchsorted(self.key, key)
        known = np.zeros(len(key), dtype=bool)
        inside = place < len(self.key)
        known[inside] = self.key[place[inside]] == key[inside]
        self.n[place[known]] += n[known]
        new = ~known
        at, size = at[new], size[new].astype(np.int32)
        bound = np.cumsum(size, dtype=np.int64)
        own = text[np.arange(bound[-1] if len(bound) else 0) + np.repeat(at - (bound - size), size)]
        where = place[new]
        self.at = np.insert(self.at, where, len(self.text) + bound - size)
        self.text += own.tobytes()
        self.size, self.key, self.n = np.insert(self.size, where, size), np.insert(self.key, where, key[new]), np.insert(self.n, where, n[new])
        self.gram, self.lang = np.insert(self.gram, where, gram[new]), np.insert(self.lang, where, lang[new])
        self.k, self.shard = np.insert(self.k, where, k[new]), np.insert(self.shard, where, shard[new])

    def batches(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        lang = pa.array(names, pa.string())
        text = np.frombuffer(self.text, dtype=np.uint8)
        for at in range(0, len(self.key), 1 << 16):
            part = slice(at, at + (1 << 16))
            size = self.size[part].astype(np.int64)
            bound = np.zeros(len(size) + 1, dtype=np.int64)
            np.cumsum(size, out=bound[1:])
            own = text[np.arange(bound[-1]) + np.repeat(self.at[part] - bound[:-1], size)]
            texts = pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(bound), pa.py_buffer(own)]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([lang.take(pa.array(self.lang[part])), pa.array(signed(self.gram[part])), texts, pa.array(self.k[part]), pa.array(self.shard[part]), pa.array(self.n[part])], schema=_COUNT)


def _global(bits: np.ndarray, wanted: np.ndarray):
    """Texts of all candidate phrases, and their counts in shards that have not counted them: (lang, gram, phrase, k, shard, n), a
    phrase's rows of a shard merged as far as a bounded table reaches.

    ``wanted`` holds each gram with its slot and with every such shard, both twice (see ``_wanted``)."""
    slots = SHARDS * SLOTS

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        place: dict[str, int] = {}
        table = Strings()
        for batch in it:
            for rows, data, off in slices(batch):
                lang = rows.column(0).dictionary_encode()
                run = Run(data, off, _lang_hash(rows.column(0), known))
                code = np.array([place.setdefault(x, len(place)) for x in lang.dictionary.to_pylist()], dtype=np.int32)[lang.indices.to_numpy()]
                slot = rows.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                text, word = run.spaced()
                grams, firsts, lengths = [], [], []
                for k in range(1, LONGEST + 1):
                    keep = _holds(bits, run.grams[-1], None)
                    gram, at = run.grams[-1][keep], run.at[-1][keep]
                    own = slot[run.doc[at]]
                    asked = np.zeros(len(gram), dtype=bool)
                    for salt in (own, slots + own % SHARDS):
                        may = np.flatnonzero(_holds(wanted, gram, salt))
                        asked[may[_holds(wanted, gram[may], salt[may] + 2 * slots)]] = True
                    grams.append(gram[asked])
                    firsts.append(at[asked])
                    lengths.append(np.full(len(grams[-1]), k, dtype=np.int32))
                    if k < LONGEST:
                        run.longer(keep)
                gram, at, k = np.concatenate(grams), np.concatenate(firsts), np.concatenate(lengths)
                shard = (slot[run.doc[at]] % SHARDS).astype(np.int32)
                key, first, n = np.unique(mix(gram + shard.astype(np.uint64) * _A), return_index=True, return_counts=True)
                at, k = at[first], k[first]
                table.add(key, n, gram[first], code[run.doc[at]], k, shard[first], text, word[at], word[at + k] - word[at] - 1)
                if len(table.key) > HELD // 2:
                    yield from table.batches(list(place))
                    table = Strings()
        yield from table.batches(list(place))

    return task


def _wanted(union: DataFrame) -> DataFrame:
    """gram and salt (as ``shard``): a gram's own slot, and beyond all slots the shards without a count; each a second time with a
    further salt, since every false positive is a row sent on."""
    slots = SHARDS * SLOTS
    salts = union.select("gram", F.explode(F.array("slot", *[F.when(F.col(f"n{i}") == 0, F.lit(slots + i)) for i in range(SHARDS)])).alias("salt")).filter("salt is not null")
    return salts.select("gram", F.explode(F.array("salt", F.col("salt") + 2 * slots)).alias("shard"))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f): every phrase of up to LONGEST words with f >= ``support`` occurrences; and (lang, n): all words of a language."""
    shards = range(SHARDS)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(SHARDS * SLOTS)).cast("int").alias("slot"), "text")
    in_shard = [F.sum(F.when(F.col("slot") % SHARDS == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in shards]
    found, bits, shares, size = [], None, None, None
    for level in (1, 2, 3):
        local = (texts.mapInArrow(_local(level, bits), "lang string, slot int, gram bigint, n bigint")
                 .groupBy("lang", "gram").agg(F.min("slot").alias("slot"), *in_shard))
        if level == 1:
            local = stored(local, "son-words")
            shares = stored(local.groupBy("lang").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in shards]).withColumn("n", sum(F.col(f"n{i}") for i in shards)), "son-size")
            size = shares.select("lang", "n")
            # the least count that a shard can be asked for: the support times its share of the words, rounded up
            shares = shares.select("lang", *[F.expr(f"cast(({support} * cast(n{i} as decimal(20,0)) + n - 1) div n as bigint)").alias(f"least{i}") for i in shards])
        frequent = [f"n{i} > 0 and n{i} >= least{i}" for i in shards]
        # a word not met in a shard is not there; a longer phrase may be, short of what the shard was asked for
        most = [f"n{i}" if level == 1 else f"if(n{i} > 0, n{i}, greatest(least{i} - 1, 0))" for i in shards]
        own = (local.join(shares, "lang").filter(" or ".join(f"({x})" for x in frequent)).filter(f"{' + '.join(most)} >= {support}")
               .select("lang", "gram", "slot", *[f"n{i}" for i in shards], F.array(*[F.expr(f"if({x}, {i}, null)") for i, x in zip(shards, frequent)]).alias("shards")))
        own = stored(own, f"son-level-{level}")
        found.append(own)
        if level < 3:
            bits = Filter(own.select("gram", F.explode("shards").alias("shard")).filter("shard is not null"), salted=True).bits
    # a word has been counted wherever it is: no shard is asked for it again
    union = found[0].withColumns({f"n{i}": F.expr(f"if(n{i} > 0, n{i}, null)") for i in shards}).unionByName(found[1]).unionByName(found[2])
    every = Filter(union.select("gram", F.lit(0).alias("shard")), salted=False).bits
    times, phrases = 1, union.count()
    while times < WANTED_TIMES and 64 * phrases > FILTER_BITS * times:
        times *= 2
    read = (texts.mapInArrow(_global(every, Filter(_wanted(union), salted=True, times=times).bits), "lang string, gram bigint, phrase string, k int, shard int, n bigint")
            .groupBy("lang", "gram", "phrase", "k").agg(*[F.sum(F.when(F.col("shard") == i, F.col("n")).otherwise(0)).alias(f"m{i}") for i in shards]))
    # what the last pass met of a phrase in a shard that had counted it, to read its text, is not its count there
    f = " + ".join(f"if(n{i} = 0, m{i}, coalesce(n{i}, 0))" for i in shards)
    counts = read.join(union, ["lang", "gram"]).select("lang", "phrase", "k", F.expr(f).alias("f")).filter(F.col("f") >= support)
    return stored(counts, "son-frequent"), size


def collocations(docs: DataFrame, support: int = SUPPORT, contained: int = CONTAINED, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of two words and more."""
    frequent, size = frequent_phrases(docs, support)
    word = F.split("phrase", " ", -1)
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    found = frequent.filter("k > 1").withColumnRenamed("f", "a").withColumn("w", word)

    longer = found.filter("k > 2").select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), s -> array_join(slice(w, s, m), ' '))))")).alias("phrase"))
    around = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = (found.join(around, ["lang", "phrase"], "left")
            .filter(f"most is null or 100 * cast(most as decimal(20,0)) < {contained} * cast(a as decimal(20,0))"))

    cuts = kept.select("lang", "phrase", "a", "w", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail"))
    cuts = (cuts.join(frequent.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
            .join(frequent.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"]))
    scored = cuts.withColumn("score", F.expr(SCORE))
    lowest = (scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("c"))
              .select("lang", "phrase", "a", "c.l", "c.r", "c.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = lowest.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
    return first.join(size, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
