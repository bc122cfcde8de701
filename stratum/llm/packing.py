"""Sum-of-squares sequence packing.

Each document's token ids (and one separator id) are cut into pieces of at most
``capacity``; only documents longer than that are cut. Longest pieces first, a
piece is placed into the open bin after which the sum over all residual gaps of
the squared count of open bins with that gap is smallest (ties: the smallest
gap left); a new bin is opened only when no open bin has room. (With new bins as
a choice like the others the rule opens 4 % more of them on even lengths.)

Scale: pieces are dealt by a hash into blocks of about ``block_rows``, the
number of blocks following the counted rows, so every task packs a bounded
group and the state is one count per gap. Full pieces are bins of their own.
Bins that a block leaves open beyond ``slack`` tokens give their pieces to a
second, smaller round, so blocks cost next to nothing in sequences. Only
(key, length) rows reach the packing tasks.

Tokens: a document is tokenised in blank-separated chunks through caches of
bounded size; the tokenizer splits at white space itself, so the ids of the
chunks in a row are the ids of the whole text (tested against it).

Defined cases: null or empty text is the separator alone, one piece. Rows with
null or repeated ids are packed like any other; they are told apart by a row
number.
"""

from __future__ import annotations

import json
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from stratum.session import scratch_dir, small_batches

CAPACITY = 2048
CACHE_CHUNKS, CACHE_WORDS = 150_000, 300_000


def _byte_alphabet() -> dict[int, int]:
    """The public byte-level BPE alphabet: printable Latin-1 bytes stand for
    themselves, the others for code points from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(rest)}


BYTE_ALPHABET = _byte_alphabet()
PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"
PIECE_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
PLACED = PIECES + ", sequence_id long, offset long, fill long"


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class ChunkEncoder:
    """Token ids of a text as little-endian uint32 bytes.

    Texts are cut at ASCII white space; a chunk's ids are cached. A chunk of
    Latin letters takes the tokenizer's own steps one by one (NFC, lower case,
    word pattern, byte alphabet, BPE model), which is several times faster than
    one call per chunk; any other chunk goes through the tokenizer as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.chunks: dict = {}
        self.old: dict = {}
        self.words: dict = {}
        stages = json.loads(self.tok.to_str())
        split = next((p["pattern"]["Regex"] for p in (stages.get("pre_tokenizer") or {}).get("pretokenizers", [])
                      if p["type"] == "Split"), None)
        steps = [n["type"] for n in (stages.get("normalizer") or {}).get("normalizers", [])]
        self.pattern = regex.compile(split) if split and steps == ["NFC", "Replace", "Lowercase"] else None
        special = {t["content"][0] for t in stages.get("added_tokens", [])}
        self.plain = regex.compile("[^" + "".join(regex.escape(c) for c in special) + r"\u0250-\U0010ffff]*")

    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            if len(self.words) >= CACHE_WORDS:
                self.words = {}
            mapped = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(BYTE_ALPHABET)
            got = self.words[word] = _packed([t.id for t in self.tok.model.tokenize(mapped)])
        return got

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if not self.pattern or not self.plain.fullmatch(text):
            return _packed(self.tok.encode(text, add_special_tokens=False).ids)
        text = text.lower()
        if text.isascii():
            if text.isalpha():
                return self._word(text)
            if text[-1] in ".,;:!?" and text[:-1].isalpha():
                return self._word(text[:-1]) + self._word(text[-1])
        else:
            text = unicodedata.normalize("NFC", text)
        return b"".join(map(self._word, self.pattern.findall(text)))

    def encode(self, text: str) -> bytes:
        raw = text.encode()
        if self.pattern and b"<" not in raw:  # special tokens are told apart by case
            raw = raw.lower()
        chunks = raw.split()  # bytes.split() cuts at ASCII white space
        known, old = self.chunks, self.old
        for c in chunks:
            if c not in known:
                known[c] = old.get(c) or self._chunk(c)
        ids = b"".join([known[c] for c in chunks])
        if len(known) >= CACHE_CHUNKS:  # chunks in use move over from the older half as they are met
            self.chunks, self.old = {}, known
        return ids


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(path: str) -> ChunkEncoder:
    """One encoder for all tasks of a Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, separator: int = 0) -> DataFrame:
    """One row of PIECES per piece. ``tokenizer``: a path that every executor sees."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(tokenizer), np.asarray([separator], "<u4").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):  # so few texts at a time become Python strings
                part = batch.slice(lo, 500)
                rows = []
                for doc, row, text in zip(*[part.column(c).to_pylist() for c in ("doc_id", "row", "text")]):
                    ids = encoder.encode(text or "") + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at:at + 4 * capacity]
                        rows.append((doc, row, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), PIECE_TYPES)],
                                      [c.split(" ")[0] for c in PIECES.split(", ")])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Bin number of each piece, in the order given; bins count from 0."""
    open_bins = np.zeros(capacity + 1, np.int64)  # by residual gap; full bins don't count
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    place, bins = np.empty(len(lengths), np.int64), 0
    for i, size in enumerate(lengths):
        fits = np.flatnonzero(open_bins[size:capacity])  # residual gaps that open bins would have left
        if len(fits):
            # change of the sum when a bin of gap fits+size gets the piece; a full bin leaves the sum
            cost = 2 * (open_bins[fits] - open_bins[fits + size] + 1)
            if fits[0] == 0:
                cost[0] = 1 - 2 * open_bins[size]
            gap = int(fits[cost.argmin()]) + size
            b = waiting[gap].pop()
            open_bins[gap] -= 1
        else:
            gap, b, bins = capacity, bins, bins + 1
        place[i] = b
        if gap - size:
            waiting[gap - size].append(b)
            open_bins[gap - size] += 1
    return place


def _pack(capacity: int):
    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row", "piece"], ascending=[False, True, True], kind="stable")
        place = sum_of_squares(pdf["length"].to_numpy(), capacity)
        pdf = pdf.assign(sequence_id=(int(key[0]) << 32) + place)
        pdf["offset"] = pdf.groupby("sequence_id")["length"].cumsum() - pdf["length"]
        pdf["fill"] = pdf.groupby("sequence_id")["length"].transform("sum")
        return pdf.drop(columns="block")
    return pack


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, block_rows: int = 16_000, slack: int = 32) -> DataFrame:
    """``pieces`` (written, as it is read twice) with ``sequence_id``, ``offset`` and ``fill``."""
    def blocks(rows: DataFrame, n: int, first: int) -> DataFrame:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("row", "piece"), F.lit(n)) + first)
        return dealt.groupBy("block").applyInPandas(_pack(capacity), PLACED)

    spark = pieces.sparkSession
    part = pieces.where(F.col("length") < capacity)
    n = max(1, -(-part.count() // block_rows))
    path = scratch_dir(spark, "packed")
    blocks(part, n, 1).write.parquet(path)
    placed = spark.read.parquet(path)
    loose = placed.where(F.col("fill") < capacity - slack)
    m = max(1, -(-loose.count() // block_rows))
    again = blocks(loose.drop("sequence_id", "offset", "fill"), m, n + 1)
    whole = (pieces.where(F.col("length") == capacity)
                   .withColumn("sequence_id", -1 - F.monotonically_increasing_id())
                   .withColumn("offset", F.lit(0).cast("long")).withColumn("fill", F.col("length")))
    return placed.where(F.col("fill") >= capacity - slack).unionByName(again).unionByName(whole)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all ``docs`` with their place in a sequence."""
    path = scratch_dir(docs.sparkSession, "pieces")
    with small_batches(docs.sparkSession):
        token_pieces(docs, tokenizer, id_col, text_col, capacity).write.parquet(path)
    return pack_pieces(docs.sparkSession.read.parquet(path), capacity)
