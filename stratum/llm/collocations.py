"""Phrase collocation mining with mergeable Misra-Gries summaries.

Phrases of 2 to 5 words are scored by how much more often they occur than their
weakest cut predicts. The work goes order by order:

1. One scan counts every word exactly.
2. For each order m = 2..5 a scan emits 64-bit keys of the m-word windows whose
   two (m-1)-word parts can be frequent, pre-aggregated in the task. The keys are
   hash-partitioned; every partition keeps a Misra-Gries summary whose capacity
   exceeds the largest partition mass / threshold, so its undercount stays below
   the threshold and no frequent phrase is lost.
3. The next scan counts the survivors exactly, by their text.

Survivors are handed to the next scan as a bit set of a fixed size
(``filter_bits``): a wrong hit costs a row that the exact count then drops, never
a phrase. Cuts are looked up by joins; products are exact decimals of 38 digits.

Scale: no step holds the phrases of the corpus in one place. A task reads batches
of a few MB, looks at ``CHUNK`` bytes at a time, adds up what it counted over all of
them, up to ``TEXTS`` texts and ``flush`` keys, and hands on batches of ``OUT`` rows. A partition's summary is bounded by the rows of its
partition, whose number follows the counted rows, and a hot phrase arrives as one
partial count per flush. The driver sees a mass and the bit sets, both of a fixed size.

Defined cases: a null or empty text has no words; a null language is ``und``;
repeated rows count each time; empty tables and tables without a frequent phrase
give no rows. A text longer than ``CHUNK`` bytes is cut at piece ends only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from stratum.operators.ordering import written
from stratum.session import scratch_dir, sized_partitions, small_batches

CHUNK = 1 << 20
TEXTS = 1 << 20
OUT = 1 << 16
BREAKS = b".,;:!?\n\x0b\x0c\r"
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(b" \t")] = 1
_CLASS[list(BREAKS)] = 2
_RNG = np.random.default_rng(20240613)
_BYTE = _RNG.integers(1, 1 << 63, (2, 256), np.uint64)  # two independent hashes of a byte
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_STEP = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _powers(n: int, base: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(max(n - 1, 0), base, np.uint64)])


class Words:
    """The words of a lower-cased UTF-8 buffer: bounds, piece numbers and two 64-bit hashes."""

    def __init__(self, buffer: bytes, lang: str):
        self.buffer = buffer
        data = np.frombuffer(buffer, np.uint8)
        kind = _CLASS[data]
        inside = kind == 0
        edge = np.diff(np.r_[False, inside, False].view(np.int8))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(kind == 2, dtype=np.int64)[self.start] if len(self.start) else np.zeros(0, np.int64)
        size = self.end - self.start
        first = np.cumsum(size) - size
        letters = data[inside]
        place = np.arange(len(letters)) - np.repeat(first, size)
        seed = sum((b + 1) * pow(_BASE[0], i + 1, 1 << 64) for i, b in enumerate(lang.encode())) % (1 << 64)
        self.seed, self.hash = np.uint64(seed), []
        for bytes_, base in zip(_BYTE, _BASE):
            value = bytes_[letters] * _powers(int(size.max(initial=0)), base)[place]
            self.hash.append(_mix(np.add.reduceat(value, first) if len(first) else np.zeros(0, np.uint64)))

    def windows(self, filters: list["BitSet"]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For order 1, 2, .. len(filters) + 1: (start words, keys, second keys) of the windows that the
        filters of all smaller orders let through."""
        h = [_mix(self.hash[0] ^ self.seed), self.hash[1]]
        alive = np.ones(len(h[0]), bool)
        for order in range(1, len(filters) + 2):
            at = np.flatnonzero(alive)
            yield at, h[0][at], h[1][at]
            if order > len(filters) or len(alive) < 2:
                return
            ok = np.zeros(len(alive), bool)
            ok[at] = filters[order - 1].holds(h[0][at])
            alive = ok[:-1] & ok[1:] & (self.piece[order:] == self.piece[:-order])
            h = [_mix(x[:-1] * step + y[order:]) for x, step, y in zip(h, _STEP, self.hash)]

    def phrase(self, at: int, order: int) -> str:
        return b" ".join(self.buffer[self.start[at]:self.end[at + order - 1]].split()).decode()


class BitSet:
    """Membership of 64-bit keys in 2^bits bits, by their upper bits: no false negatives."""

    def __init__(self, packed: np.ndarray, bits: int):
        self.packed, self.shift = packed, np.uint64(64 - bits)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = (keys >> self.shift).astype(np.int64)
        return (self.packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def buffers(texts: list[bytes], chunk: int = CHUNK) -> Iterator[bytes]:
    """The texts, joined by piece ends, in buffers of about ``chunk`` bytes."""
    held, size = [], 0
    for data in texts:
        while len(data) > chunk:
            cut = max(data.rfind(b, 0, chunk) for b in (bytes([c]) for c in BREAKS))
            if cut < 0:  # one piece longer than a chunk: up to its end
                ends = [i for i in (data.find(bytes([c]), chunk) for c in BREAKS) if i >= 0]
                cut = min(ends, default=len(data) - 1)
            yield data[:cut + 1]
            data = data[cut + 1:]
        held.append(data)
        size += len(data)
        if size >= chunk:
            yield b"\n".join(held)
            held, size = [], 0
    if held:
        yield b"\n".join(held)


def language_buffers(batches, chunk: int = CHUNK) -> Iterator[tuple[str, bytes]]:
    """(language, buffer of its texts, A-Z lower-cased). Texts wait for others of their language, of later batches too,
    up to about ``chunk`` bytes of a language and 8 times that of all."""
    waiting: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            if not text:
                continue
            lang = "und" if lang is None else lang
            waiting.setdefault(lang, []).append(text.lower())
            sizes[lang] = sizes.get(lang, 0) + len(text)
            if sizes[lang] >= chunk:
                sizes.pop(lang)
                for buffer in buffers(waiting.pop(lang), chunk):
                    yield lang, buffer
        if sum(sizes.values()) >= 8 * chunk:
            for lang in list(waiting):
                sizes.pop(lang)
                for buffer in buffers(waiting.pop(lang), chunk):
                    yield lang, buffer
    for lang, texts in waiting.items():
        for buffer in buffers(texts, chunk):
            yield lang, buffer


def _totals(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(counts, first) if len(first) else counts)


_SCAN = pa.schema([("kind", pa.string()), ("lang", pa.string()), ("phrase", pa.string()), ("key", pa.int64()), ("n", pa.int64())])
_SCAN_DDL = "kind string, lang string, phrase string, key bigint, n bigint"


def _out(kind: str, lang, phrase, key, n) -> Iterator[pa.RecordBatch]:
    """Counts as batches of at most ``OUT`` rows; columns that are None are null."""
    for i in range(0, len(n), OUT):
        m = len(n[i:i + OUT])
        given = [pa.nulls(m, t) if c is None else c[i:i + OUT] for c, t in ((lang, pa.string()), (phrase, pa.string()), (key, pa.int64()))]
        yield pa.RecordBatch.from_arrays([pa.array([kind] * m), *given, n[i:i + OUT]], schema=_SCAN)


def _scan(batches, filters: list[BitSet], exact: int | None, summarised: int | None, chunk: int, flush: int, most_texts: int = TEXTS):
    """Counts by text of the windows of order ``exact`` that pass its filter (every word for order 1), and counts by
    key of the candidate windows of order ``summarised``: added up in the task, and flushed where that shortens little."""
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    texts: list[pa.Table] = []

    def keyed(limit: int):
        nonlocal keys, counts
        if sum(map(len, keys)) <= limit:
            return
        k, keys = np.concatenate(keys), []
        n, counts = np.concatenate(counts), []
        k, n = _totals(k, n)
        if len(k) > limit // 2:
            yield from _out("key", None, None, pa.array(k.view(np.int64)), pa.array(n))
        else:
            keys, counts = [k], [n]

    def by_text(limit: int):
        nonlocal texts
        if sum(map(len, texts)) <= limit:
            return
        added = pa.concat_tables(texts).combine_chunks().group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
        texts = []
        if len(added) > limit // 2:
            for b in added.select(["lang", "phrase", "n_sum"]).to_batches():
                yield from _out("text", b.column(0), b.column(1), None, b.column(2))
        else:
            texts = [added.rename_columns({"n_sum": "n"})]

    for lang, buffer in language_buffers(batches, chunk):
        words = Words(buffer, lang)
        for order, (at, key, check) in enumerate(words.windows(filters), 1):
            if order == exact and len(at):
                if order <= len(filters):
                    ok = filters[order - 1].holds(key)
                    at, key, check = at[ok], key[ok], check[ok]
                by = np.argsort(key, kind="stable")
                k, c = key[by], check[by]
                # a new group also where only the second hash differs: one text per group
                first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])][:len(k)])
                n = np.diff(np.r_[first, len(k)]).astype(np.int64)
                phrases = pa.array((words.phrase(i, order) for i in at[by[first]]), pa.string(), size=len(first))
                if len(first):
                    texts.append(pa.table({"lang": pa.repeat(lang, len(first)), "phrase": phrases, "n": n}))
                    yield from by_text(most_texts)
            if order == summarised and len(at):
                k, n = _totals(key, np.ones(len(key), np.int64))
                keys.append(k)
                counts.append(n)
                yield from keyed(flush)
    if keys:
        keys, counts = [np.concatenate(keys)], [np.concatenate(counts)]
        yield from keyed(0)
    if texts:
        yield from by_text(0)


class MisraGries:
    """A mergeable summary of at most ``capacity`` counters; ``undercount`` bounds what any count lacks."""

    def __init__(self, capacity: int):
        self.capacity, self.undercount = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._new: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._new.append((keys, counts))
        self._size += len(keys)
        if self._size > max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self._new]])
        counts = np.concatenate([self.counts, *[n for _, n in self._new]])
        self._new, self._size = [], 0
        keys, counts = _totals(keys, counts)
        if len(keys) > self.capacity:
            cut = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            counts = counts - cut
            keys, counts = keys[counts > 0], counts[counts > 0]
            self.undercount += cut
        self.keys, self.counts = keys, counts

    def at_least(self, threshold: int) -> np.ndarray:
        """Keys that may have ``threshold`` occurrences."""
        self.merge()
        return self.keys[self.counts + self.undercount >= threshold]


def _summaries(batches, capacity: int, threshold: int):
    held: dict[int, MisraGries] = {}
    for batch in batches:
        part, key, n = (batch.column(i).to_numpy() for i in range(3))
        for p in np.unique(part):
            mine = part == p
            held.setdefault(int(p), MisraGries(capacity)).add(key[mine].view(np.uint64), n[mine])
    for summary in held.values():
        keys = summary.at_least(threshold)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])


def survivors(partial: DataFrame, threshold: int) -> DataFrame:
    """Keys of ``partial`` (key, n) that may reach ``threshold``; every key that does is among them."""
    parts = sized_partitions(partial, 1_000_000)
    dealt = partial.select(F.pmod(F.shiftright("key", 7), F.lit(parts)).cast("int").alias("part"), "key", "n")
    mass = dealt.groupBy("part").agg(F.sum("n").alias("m")).agg(F.max("m")).first()[0] or 0
    capacity = mass // threshold + 1
    return dealt.repartition(parts, "part").mapInArrow(lambda b: _summaries(b, capacity, threshold), "key bigint")


def bit_set(keys: DataFrame, bits: int) -> np.ndarray | None:
    """The packed bits of ``keys``, of a fixed size; None if there is no key. A group holds distinct bit numbers only."""
    chunks = 64
    width = (1 << bits) // chunks
    at = keys.select(F.shiftrightunsigned("key", 64 - bits).alias("bit")).distinct()

    def pack(group: pa.Table) -> pa.Table:
        on = np.zeros(width, np.uint8)
        on[group.column("bit").to_numpy() % width] = 1
        return pa.table({"c": group.column("c")[:1], "packed": [np.packbits(on, bitorder="little").tobytes()]})

    rows = at.withColumn("c", F.expr(f"bit div {width}").cast("int")).groupBy("c").applyInArrow(pack, "c int, packed binary").collect()
    if not rows:
        return None
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:
        out[r["c"] * width // 8:(r["c"] + 1) * width // 8] = np.frombuffer(r["packed"], np.uint8)
    return out


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 5,
                     min_count: int = 100, filter_bits: int = 26, chunk: int = CHUNK,
                     flush: int = 2_000_000) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f) of all phrases of 1 to ``max_words`` words with f >= min_count, (lang, n) word totals)."""
    spark = docs.sparkSession
    context = spark.sparkContext
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    filters: list[np.ndarray] = []
    found: list[DataFrame] = []

    def scan(exact: int | None, summarised: int | None) -> tuple[DataFrame, DataFrame]:
        held = context.broadcast(filters)  # at most max_words bit sets of 2^filter_bits bits
        path = scratch_dir(spark, f"phrases-{exact or 0}-{summarised or 0}")

        def run(batches):
            sets = [BitSet(x, filter_bits) for x in held.value]
            return _scan(batches, sets, exact, summarised, chunk, flush)

        with small_batches(spark):
            texts.mapInArrow(run, _SCAN_DDL).write.partitionBy("kind").parquet(path)
        rows = spark.read.schema(_SCAN_DDL).parquet(path)
        return (rows.where("kind = 'text'").groupBy("lang", "phrase").agg(F.sum("n").alias("f")),
                rows.where("kind = 'key'").select("key", "n"))

    counted = written(scan(1, None)[0], "words")
    totals = written(counted.groupBy("lang").agg(F.sum("f").alias("n")), "word-totals")

    def keep(counts: DataFrame, order: int) -> DataFrame:
        return counts.where(F.col("f") >= min_count).select("lang", "phrase", F.lit(order).alias("words"), "f")

    found.append(keep(counted, 1))

    def word_keys(batches):
        for batch in batches:
            for lang, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key = next(Words(word.encode(), lang).windows([]))[1]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["key"])

    bits = bit_set(found[0].select("lang", "phrase").mapInArrow(word_keys, "key bigint"), filter_bits)
    exact = None
    for order in range(2, max_words + 2):
        if bits is None:
            break
        filters = [*filters, bits]
        if order > max_words:
            counts, _ = scan(exact, None)
        else:
            counts, partial = scan(exact, order)
        if exact is not None:
            found.append(written(keep(counts, exact), f"phrases-of-{exact}"))
        if order <= max_words:
            bits = bit_set(survivors(partial, min_count), filter_bits)
        exact = order
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out, totals


def cut_score() -> Column:
    """floor(1000 a n / (l r)) of those columns, exact: the products have up to 38 digits."""
    return F.expr("cast((cast(1000 as decimal(4,0)) * cast(a as decimal(19,0)) * cast(n as decimal(19,0)))"
                  " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as bigint)")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 5,
                 min_count: int = 100, top: int = 2000, inside_pct: int = 100, **scan) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of every language.

    A phrase whose words lie inside a longer frequent one with at least ``inside_pct`` % of its count is left out."""
    found, totals = frequent_phrases(docs, text_col, lang_col, max_words, min_count, **scan)
    found = written(found, "phrases")
    whole = found.where("words >= 2").withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " "))

    def part(start, size):
        return F.array_join(F.slice("w", start, size), " ")

    k = F.col("k")
    cuts = (whole.select("lang", "phrase", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
                 .select("lang", "phrase", "a", "k", part(F.lit(1), k).alias("left"),
                         part(k + 1, F.col("words") - k).alias("rest")))
    one = found.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    two = found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    big = "decimal(38,0)"
    scored = (cuts.join(one, ["lang", "left"]).join(two, ["lang", "rest"]).join(totals, "lang")
                  .withColumn("score", cut_score())
                  .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
                  .select("lang", "phrase", "a", "n", "_cut.score", "_cut.l", "_cut.r"))
    shorter = (whole.where("words >= 3")
               .select("lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
               .select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("s"))
               .select("lang", "a", part(F.col("s"), F.col("size")).alias("phrase"))
               .groupBy("lang", "phrase").agg(F.max("a").alias("_longer")))
    kept = (scored.join(shorter, ["lang", "phrase"], "left")
                  .where(F.col("_longer").isNull() | (F.col("_longer").cast(big) * 100 < F.col("a").cast(big) * inside_pct)))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    return (kept.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
                .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
