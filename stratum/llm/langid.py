"""Language identification by cross-parsing entropy.

Per language a suffix automaton is built over a bounded sample of labelled
text. A text is cross-parsed against it: from each position the longest match
with any substring of the sample is one phrase. A phrase costs log2 of the
sample's length in bits; the language with the fewest bits per symbol wins.

Learning: for each non-null value of lang that has a text with a letter, the
``sample_rows`` labelled rows of smallest hash, those of at most ``row_chars``
code points first (longer ones give that many), up to ``sample_symbols``
symbols; fewer of each, if all languages together would have more than ``total_rows``. What
reaches the driver is bounded by these parameters; more languages than ``total_rows`` raise.
Predicting reads every text in full.

The automata are hash tables of their edges, so any number of letters fits,
built once per Python worker from the sample. Texts are parsed in blocks of
``BLOCK`` symbols, many blocks in lockstep with numpy, so a very long text costs what short ones of its length cost; a
phrase goes on over the edge of a block (``_block_phrases``), so the counts are those of the text as a whole.

Symbols: lower-cased letters of the sample; every run of other characters is
one blank; a letter that no sample holds matches nothing.

Defined cases: a null text or one without a letter is ``und`` with score 0, and
so is any text if nothing was learned. Equal costs: the alphabetically first
language, score 0. The score is 1 - best cost / second cost, times the number
of languages it had to beat, at most 1; with one language it is 1. A null id
counts as the empty text in the fold rule.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

BLOCK = 512
POINTS = 0x110000


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def learning_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    sample_rows: int = 64, row_chars: int = 4000, sample_symbols: int = 40_000,
                    total_rows: int = 8192) -> dict[str, str]:
    """Language -> sample text, from the rows of ``docs`` (the learning fold)."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    langs = rows.agg(F.count_distinct(lang_col)).first()[0]
    if langs > total_rows:
        raise ValueError(f"{langs} languages; total_rows allows {total_rows}")
    sample_rows = min(sample_rows, total_rows // max(langs, 1))
    order = Window.partitionBy(lang_col).orderBy("_long", "_h", id_col)
    picked = (rows.select(lang_col, id_col, (F.char_length(text_col) > row_chars).alias("_long"),
                            F.xxhash64(id_col).alias("_h"), F.substring(text_col, 1, row_chars).alias("_t"))
                    .withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= sample_rows)
                    .select(lang_col, "_rn", "_t").collect())
    sample: dict[str, str] = {lang: "" for lang in sorted({r[0] for r in picked})}
    for lang, _, text in sorted(picked):
        if len(sample[lang]) < sample_symbols:
            sample[lang] = f"{sample[lang]} {text}"[:sample_symbols]
    return sample


class Edges:
    """(state, symbol) -> next state, 0 for none: an open hash table, looked up for whole arrays."""

    def __init__(self, nxt: list[dict], alphabet: int):
        self.alphabet = alphabet
        keys = np.array([state * alphabet + c for state, edges in enumerate(nxt) for c in edges], np.int64)
        values = np.array([to for edges in nxt for to in edges.values()], np.int32)
        bits = (2 * len(keys) + 1).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            self.keys[at[free]] = keys[free]  # one of several for a slot gets it
            won = free[self.keys[at[free]] == keys[free]]
            self.values[at[won]] = values[won]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & self.mask
        self.root = self.follow(np.zeros(alphabet, np.int64), np.arange(alphabet))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def follow(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        key = state.astype(np.int64) * self.alphabet + symbol
        at = self._slot(key)
        found = self.keys[at]
        to = np.where(found == key, self.values[at], 0)
        left = np.flatnonzero((found != key) & (found >= 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            found = self.keys[at[left]]
            hit = found == key[left]
            to[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (found >= 0)]
        return to


def suffix_automaton(seq: list[int], alphabet: int) -> Edges:
    """The edges of all states; none leads to the root."""
    nxt, link, length = [{}], [-1], [0]
    last = 0
    for c in seq:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return Edges(nxt, alphabet)


def _block_phrases(table: Edges, flat: np.ndarray, begin: np.ndarray, length: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Phrases that start in each block, the blocks of a text parsed as one text.

    All blocks are first parsed side by side, each as if a phrase started with it. A
    block that ``follows`` another one is then parsed again from the state its
    predecessor ends in, up to a place where both parses start a phrase: from there on
    they are the same. A block that comes to no such place ends in another state than first
    thought, and its successor is done once more."""
    starts = np.zeros(len(flat), bool)
    count, alone, _ = _walk(table, flat, begin, length, np.zeros(len(begin), np.int32), starts, None)
    state, upto = alone.copy(), np.cumsum(starts)
    todo = np.flatnonzero(follows)
    while len(todo):
        count[todo], ends, met = _walk(table, flat, begin[todo], length[todo], state[todo - 1], starts, upto)
        ends = np.where(met, alone[todo], ends)
        after = todo[ends != state[todo]] + 1
        state[todo] = ends
        after = after[after < len(begin)]
        todo = after[follows[after]]
    return count


def _walk(table: Edges, flat: np.ndarray, begin: np.ndarray, length: np.ndarray, state: np.ndarray, starts: np.ndarray,
          upto: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrases, end states, met) of blocks entered in ``state``, 0 for a phrase's start. The first parse (no ``upto``) marks
    its ``starts``; a later one stops where it starts a phrase at a marked place and takes the rest from the running count."""
    order = np.argsort(-length, kind="stable")
    n, now, met = np.zeros(len(begin), np.int64), state.astype(np.int32), np.zeros(len(begin), bool)
    first, left, cur, got, who = begin[order], length[order], now[order], n[order], order
    for t in range(int(length.max(initial=0))):
        k = len(left) - np.searchsorted(left[::-1], t, side="right")
        if k < len(left):  # blocks that end here
            now[who[k:]], n[who[k:]] = cur[k:], got[k:]
            first, left, cur, got, who = first[:k], left[:k], cur[:k], got[:k], who[:k]
        if not k:
            break
        at = first + t
        symbol = flat[at]
        to = table.follow(cur, symbol)
        new = (to == 0) | (cur == 0)
        got += new
        cur = np.where(to == 0, table.root[symbol], to)
        if upto is None:
            starts[at[new]] = True
        else:
            same = new & starts[at]
            if same.any():
                done, go = who[same], ~same
                n[done] = got[same] + upto[begin[done] + length[done] - 1] - upto[at[same]]
                met[done] = True
                first, left, cur, got, who = first[go], left[go], cur[go], got[go], who[go]
    now[who], n[who] = cur, got
    return n, now, met


class CrossParser:
    def __init__(self, sample: dict[str, str]):
        letters = sorted({c for text in sample.values() for c in text.lower() if c.isalpha()})
        self.unknown = len(letters) + 1  # letters of no sample: no automaton has an edge for it
        self.map = np.fromiter((self.unknown if chr(cp).isalpha() else 0 for cp in range(POINTS)), np.int32, POINTS)
        for i, c in enumerate(letters):
            self.map[ord(c)] = i + 1
        self.langs, self.tables, self.bits = [], [], []
        for lang in sorted(sample):
            symbols = self.symbols(sample[lang])
            if len(symbols):
                self.langs.append(lang)
                self.tables.append(suffix_automaton(symbols.tolist(), self.unknown + 1))
                self.bits.append(math.log2(len(symbols) + 1))

    def symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        s = self.map[points]
        if len(s) > 1:
            s = s[np.r_[True, (s[1:] != 0) | (s[:-1] != 0)]]
        return s

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases [text, language], symbols [text])."""
        coded = [self.symbols(t) for t in texts]
        size = np.array([len(c) for c in coded], np.int64)
        blocks = -(-size // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        first = np.repeat(np.cumsum(size) - size, blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin, length = first + nth * BLOCK, np.minimum(BLOCK, np.repeat(size, blocks) - nth * BLOCK)
        flat = np.concatenate([*coded, np.zeros(1, np.int32)])
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        for j, table in enumerate(self.tables):
            np.add.at(out[:, j], owner, _block_phrases(table, flat, begin, length, nth > 0))
        return out, size

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        got: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        at = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if not at or not self.langs:
            return got
        counts, size = self.phrases([texts[i] for i in at])
        cost = counts * np.array(self.bits) / np.maximum(size, 1)[:, None]
        best = cost.argmin(axis=1)
        rank = np.sort(cost, axis=1)
        for row, i in enumerate(at):
            score = 1.0 if len(self.langs) == 1 else min(1.0, (1 - rank[row, 0] / rank[row, 1]) * len(self.langs))
            got[i] = (self.langs[best[row]], float(score))
        return got


_PARSERS: dict[int, CrossParser] = {}


def _parser(sample: dict[str, str]) -> CrossParser:
    """Built once per Python worker and sample."""
    key = hash(tuple(sorted(sample.items())))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = CrossParser(sample)
    return _PARSERS[key]


def predict_language(docs: DataFrame, sample: dict[str, str], text_col: str = "text") -> DataFrame:
    """``docs`` with its columns, plus ``_lang_pred`` and ``_score``."""
    held = docs.sparkSession.sparkContext.broadcast(sample)

    @F.pandas_udf("lang string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        parser = _parser(held.value)
        rows: list = []
        values = [None if t is None else t for t in texts]
        for lo in range(0, len(values), 1000):
            rows += parser.predict(values[lo:lo + 1000])
        return pd.DataFrame(rows, columns=["lang", "score"])

    out = docs.withColumn("_p", guess(F.col(text_col)))
    return out.withColumn("_lang_pred", F.col("_p.lang")).withColumn("_score", F.col("_p.score")).drop("_p")
