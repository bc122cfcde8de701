"""Conversation repair, source mixing and collocations against brute force on small awkward tables."""

import hashlib
import heapq
import itertools
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratum.llm import collocations, conversation_repair as cr, mixing
from stratum.operators import ordering as order
from tests.llm import fixtures as fx

CONV = "conv_id bigint, turn bigint, role string, text string"


# --- conversation repair -----------------------------------------------------------

LEGAL = re.compile(r"(s?(ua)+)?\Z")


def kinds_of(rows):
    out, seen = [], set()
    for _, role, text in rows:
        body = text.strip("\x20\t\n\v\f\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "ok" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute_repair(rows):
    """Cheapest edits, ties ASCII-least, by best-first search over (cost, edits): no DP, no automaton."""
    kinds = kinds_of(rows)
    heap = [(0, "", 0, ())]
    done = set()
    while True:
        cost, edits, i, turns = heapq.heappop(heap)
        initials = "".join(r[:1] for r, _ in turns)
        if i == len(rows) and LEGAL.match(initials):
            return cost, edits, turns
        tail = initials[-1:] if initials else "^"
        if (i, tail, edits) in done:
            continue
        done.add((i, tail, edits))
        if not any(LEGAL.match(initials + x) for x in ("", "a", "ua")):
            continue
        for role in ("user", "assistant"):
            if edits.count("I") <= 2 * len(rows) + 2:
                heapq.heappush(heap, (cost + 5, edits + "I", i, turns + ((role, ""),)))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 2, edits + "D", i + 1, turns))
            if kinds[i] in ("ok", "truncated"):
                extra = 5 if kinds[i] == "truncated" else 0
                if role:  # an empty role has no initial, so it can't stay
                    heapq.heappush(heap, (cost + extra, edits + "K", i + 1, turns + ((role, text),)))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + extra + 1, edits + "R", i + 1, turns + ((new, text),)))


def figures(rows):
    kinds = Counter(kinds_of(rows))
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, turns = brute_repair(rows)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
    return gaps, kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal, cost, audit, digest


def clean(rows):
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def random_conversations(n, longest=6, seed=5):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        for t in range(rng.randrange(longest + 1)):
            out.append((c, rng.choice([t, t, t, t + 1, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]),
                        rng.choice(["Fine.", "Well?", "cut off", "", None, " \t\n", f"No {t}!", f"ends {t} badly", "Yes. "])))
    return out


CASES = random_conversations(60) + [(None, 0, "user", "Hm."), (None, None, None, None), (900, 2, "system", "Be brief."),
                                    (901, 0, "user", "x." * 40_000), (901, 1, "assistant", "y")]


def want_repairs(cases):
    by = defaultdict(list)
    for c, t, r, x in cases:
        by[c].append((t, r, x))
    return {c: figures(clean(rows)) for c, rows in by.items()}


@pytest.fixture(scope="module")
def repaired():
    return want_repairs(CASES)


@pytest.mark.parametrize("limits", [{}, {"whole_rows": 0, "block_rows": 1}, {"whole_rows": 2, "whole_bytes": 40, "block_rows": 2}])
def test_repair_equals_a_search_over_all_edits(spark, repaired, limits):
    df = fx.extra_columns(spark.createDataFrame(CASES, CONV).repartition(5))
    got = {r["conv"]: tuple(r[c] for c in cr.FIGURES) for r in cr.repair_conversations(df, **limits).collect()}
    assert got == repaired


def test_blocks_of_a_long_conversation_equal_the_whole(spark):
    rng = random.Random(3)
    rows = [(7, i, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"t{i}.", f"t{i}", "", "same."])) for i in range(700)]
    df = spark.createDataFrame(rows, CONV)
    whole, blocks = (cr.repair_conversations(df, **k).collect() for k in ({}, {"whole_rows": 50, "block_rows": 8}))
    assert whole == blocks and len(whole) == 1 and whole[0]["duplicate"] > 0
    turns = cr.repair_conversations(df, repaired_turns=True, whole_rows=50, block_rows=8).orderBy("position").collect()
    text = "\n".join(f"{t['role']}:{t['text']}" for t in turns)
    assert hashlib.sha256(text.encode()).hexdigest() == whole[0]["repaired_sha256"]
    assert LEGAL.match("".join(t["role"][0] for t in turns)) and [t["position"] for t in turns] == list(range(len(turns)))


def test_walk_holds_a_square_root_of_vectors(monkeypatch):
    rows, held = [("u", False, False), ("a", False, False)] * 5000, []
    real = cr.before
    monkeypatch.setattr(cr, "before", lambda r, v: held.append(1) or real(r, v))
    pieces, q = cr.walk(rows, cr.START, cr.END)
    assert set(pieces) == {"K"} and q == cr.ASSISTANT and len(held) == 2 * len(rows)  # each vector made twice, none kept


def test_damage_follows_the_contract(spark):
    import zlib
    rows = [(c, t, r, x) for c in range(30) for t, (r, x) in enumerate([("user", "A. b!"), ("assistant", "c?"), (None, None)])] + [(None, None, "user", "x.")]
    got = sorted(map(repr, (tuple(r) for r in cr.damage(fx.extra_columns(spark.createDataFrame(rows, CONV))).collect())))
    want = []
    for c, t, r, x in rows:
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if d == 1 else re.sub("[.!?]", "", x) if d == 2 else x
        want += [repr((c, t, "user" if d == 4 else r, x, d == 0))] * (2 if d == 3 else 1)
    assert got == sorted(want)


def test_conversation_that_lost_all_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "user", "a.", True), (2, 0, "user", "a.", None)], CONV + ", lost boolean")
    got = {r["conv"]: r for r in cr.repair_conversations(df, lost_col="lost").collect()}
    assert got[1]["audit"] == "" and got[1]["cost"] == 0 and got[1]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[2]["cost"] == 2 and got[2]["audit"] == "D"
    assert cr.repair_conversations(df.limit(0)).count() == 0


# --- mixing ------------------------------------------------------------------------

def brute_mix(rows, budget_pct=150):
    """(id, text, source) rows -> sorted (id, size, source size, target, taken)."""
    size = [len(fx.words_of(t)) for _, t, _ in rows]
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    budget = sum(size) * budget_pct / 100
    full: set = set()
    while True:
        left = budget - sum(2 * total[s] for s in full)
        w = sum(weight[s] for s in sources if s not in full)
        more = {s for s in sources if s not in full and weight[s] * left / w > 2 * total[s]}
        if not more:
            break
        full |= more
    target = {s: 2 * total[s] if s in full else weight[s] * left / w for s in sources}
    copies = []
    for place, s in enumerate(sources):
        mine = sorted((hashlib.md5(f"{' ' if i is None else i}:{t or ''}".encode()).hexdigest(), k) for k, (i, t, x) in enumerate(rows) if x == s)
        for epoch in range(2):
            at = 0
            for _, k in mine:
                at += size[k]
                if size[k]:
                    copies.append(((epoch * total[s] + at) / target[s], place, epoch, at, k))
    taken, run = Counter(), 0
    for *_, k in sorted(copies):
        run += size[k]
        if run > budget:
            break
        taken[k] += size[k]
    return sorted(repr((rows[k][0], size[k], total[rows[k][2]], round(float(target[rows[k][2]]), 6), taken[k])) for k in range(len(rows)))


def mixed(df, **kw):
    return sorted(repr((r["id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]))
                  for r in mixing.mix_plan(df, **kw).collect())


def test_mix_equals_brute_force_on_awkward_rows(spark):
    rows = fx.awkward() + [fx.doc(300 + i, fx.prose(i, 50), source=f"s{i % 7}") for i in range(90)]
    rows += [fx.doc(999, fx.prose(999, 30), source="hot")] * 60  # one repeated row holds a third of all
    df = fx.extra_columns(spark.createDataFrame(rows, fx.DOCS))
    want = brute_mix([(i, t, s) for i, t, _, s, _ in rows])
    assert mixed(df) == want and mixed(df.repartition(7)) == want  # reruns agree on any partitioning


def test_mix_reaches_targets(spark):
    rows = [fx.doc(i, fx.prose(i, 20 + i % 60), source="abc"[min(2, i % 5)]) for i in range(1500)]
    plan = mixing.mix_plan(spark.createDataFrame(rows, fx.DOCS)).collect()
    for s in "abc":
        mine = [r for r in plan if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 160
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in plan)
    total = sum(r["size"] for r in plan)
    assert 1.5 * total - 80 < sum(r["taken"] for r in plan) <= 1.5 * total


def test_mixed_sequence_holds_the_taken_texts_in_order(spark):
    rows = [fx.doc(i, fx.prose(i % 40, 30), source="ab"[i % 2]) for i in range(80)] + [fx.doc(1, None)]
    df = spark.createDataFrame(rows, fx.DOCS)
    seq = mixing.mixed_sequence(df).collect()
    plan = {(r["id"], r["source"]): r["taken"] for r in mixing.mix_plan(df).where("taken > 0").collect()}
    words = Counter()
    for r in seq:
        words[r["id"], r["source"]] += len(fx.words_of(r["text"]))
    assert dict(words) == plan
    assert [r["finish"] for r in seq] == sorted(r["finish"] for r in seq)


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], fx.DOCS)
    assert mixing.mix_plan(empty).count() == 0
    blank = mixing.mix_plan(spark.createDataFrame([fx.doc(1, None), fx.doc(2, " \n", source=None)], fx.DOCS)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in blank] == [(0, 0.0, 0)] * 2


def test_water_level_with_many_caps(spark):
    sizes = [(f"s{i:02}", n) for i, n in enumerate([1, 1, 2, 3, 5, 8, 13, 400, 21, 34, 55, 89, 0])]
    got = mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size long"), 948.0).collect()
    assert abs(sum(r["target"] for r in got) - 948) < 1e-6
    assert all(r["target"] <= 2 * r["source_size"] for r in got)
    free = [(r["target"], (3, 1, 2)[r["place"] % 3]) for r in got if r["target"] < 2 * r["source_size"]]
    assert len({round(t / w, 9) for t, w in free}) == 1


def test_places_and_running_sums(spark):
    df = spark.range(0, 5000).selectExpr("pmod(xxhash64(id), 40) as g", "id as n")
    got = order.placed(df, ["g", "n"], "t", running="n", rows_per_task=300).orderBy("_at").collect()
    rows = sorted((r["g"], r["n"]) for r in df.collect())
    assert [(r["g"], r["n"]) for r in got] == rows and [r["_at"] for r in got] == list(range(5000))
    assert [r["_run"] for r in got] == list(itertools.accumulate(n for _, n in rows))


# --- collocations ------------------------------------------------------------------

def brute_collocations(rows, min_count, top=2000):
    """(lang, text) rows."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(fx.UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                f.update((lang, *w[i:i + m]) for i in range(len(w) - m + 1))
    frequent = {k: a for k, a in f.items() if len(k) > 2 and a >= min_count}
    out = defaultdict(list)
    longer: Counter = Counter()
    for (lang, *w), a in frequent.items():
        for z in range(2, len(w)):
            for s in range(len(w) - z + 1):
                key = (lang, *w[s:s + z])
                longer[key] = max(longer[key], a)
    for (lang, *w), a in frequent.items():
        cuts = [((1000 * a * n[lang]) // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w))]
        score, _, left, rest = min(cuts)
        if longer[lang, *w] < a:
            out[lang].append((-score, -a, " ".join(w).encode(), left, rest))
    got = []
    for lang, rows_ in out.items():
        for rank, (s, a, p, left, rest) in enumerate(sorted(rows_)[:top], 1):
            got.append((lang, rank, p.decode(), -a, left, rest, n[lang], -s))
    return sorted(got)


def phrase_rows():
    rng = random.Random(11)
    words = ["the", "of", "and", "Über", "straße", "中文", "x1", "York", "new", "NEW", "in", "fact", " ", "e\x1cf"]
    rows = []
    for i in range(150):
        body = [rng.choice(words) for _ in range(rng.randrange(60))] + ["New", "York", "in", "fact", "of", "course"] * (i % 3)
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", ";x ", "\x0c", "! "]) for w in body)
        rows.append((rng.choice(["en", "de", None, "und"]), text))
    return rows + [("en", None), ("fr", ""), (None, None), ("en", "one two three " * 4000), ("es", "...!?"), ("de", "a" * 5000)] + [("en", "so on and so forth")] * 40


@pytest.mark.parametrize("limits", [{"top": 2000}, {"top": 3, "chunk": 64, "flush": 20, "filter_bits": 12}])
def test_collocations_equal_brute_force(spark, limits):
    """Also with flushes after every few keys and bit sets so small that most windows pass them."""
    rows = phrase_rows()
    df = fx.extra_columns(spark.createDataFrame(rows, "lang string, text string").repartition(4))
    got = sorted(tuple(r) for r in collocations.collocations(df, min_count=6, **limits).collect())
    assert got == brute_collocations(rows, 6, limits["top"])


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).count() == 0
    rare = spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")
    assert collocations.collocations(rare).count() == 0


def test_a_scan_of_much_text_needs_little_memory():
    """24 MB of one language: the scan holds about 1 MB of it at a time, and hands on rows in small batches."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 200_000, 20_000)) for _ in range(170)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"])
    every = collocations.BitSet(np.full(1 << 9, 255, np.uint8), 12)
    total = {"text": 0, "key": 0}
    tracemalloc.start()
    for out in collocations._scan([batch], [every], 1, 2, collocations.CHUNK, 1_000_000):
        assert out.num_rows <= collocations.OUT
        total[out.column("kind")[0].as_py()] += sum(out.column("n").to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == {"text": 170 * 20_000, "key": 170 * 19_999}
    assert peak < 240 << 20  # 24 MB of it are the texts as the batch's rows


@pytest.mark.parametrize("most", [20, collocations.TEXTS])
def test_counts_of_all_buffers_are_added_up(most):
    """A text counted in many buffers of a task leaves it as one row, or as few if there are many texts."""
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de"] * 300), pa.array(["a b c a"] * 600)], names=["lang", "text"])
    every = collocations.BitSet(np.full(1 << 9, 255, np.uint8), 12)
    rows = [r for b in collocations._scan([batch], [every], 1, 2, 64, 4_000_000, most) for r in b.to_pylist()]
    texts, keys = ([r for r in rows if r["kind"] == kind] for kind in ("text", "key"))
    assert sorted((r["lang"], r["phrase"], r["n"]) for r in texts) == sorted(
        (lang, w, n) for lang in ("de", "en") for w, n in (("a", 600), ("b", 300), ("c", 300)))
    assert sorted(r["n"] for r in keys) == [300] * 6


def test_texts_of_a_language_wait_for_each_other():
    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())],
                                          names=["lang", "text"])

    rows = [("en", "A b"), (None, "ÄX"), ("de", None), ("en", ""), ("und", "c"), ("en", "d, " * 30), ("fr", "e")]
    got = list(collocations.language_buffers([batch(rows[:2]), batch(rows[2:5]), batch(rows[5:])], 50))
    assert got == [("en", b"d, " * 16 + b"d,"), ("en", b"a b\n " + b"d, " * 13), ("und", "Äx\nc".encode()), ("fr", b"e")]
    many = [(f"l{i}", "x" * 9) for i in range(100)]
    got = list(collocations.language_buffers([batch(many[i:i + 10]) for i in range(0, 100, 10)], 10))
    assert got == [(lang, text.encode()) for lang, text in many]


@pytest.mark.parametrize("capacity_extra", [0, 3])
def test_summaries_keep_every_frequent_key(capacity_extra):
    rng = np.random.default_rng(1)
    keys = np.r_[rng.zipf(1.3, 40_000) % 5000, np.repeat(np.arange(9000, 9040), 100)].astype(np.uint64)
    rng.shuffle(keys)
    threshold, parts = 100, 16
    summary = collocations.MisraGries(len(keys) // threshold + 1 + capacity_extra)
    for part in np.array_split(keys, parts):  # each with its own summary, then merged
        own = collocations.MisraGries(summary.capacity)
        own.add(*np.unique(part, return_counts=True))
        own.merge()
        summary.add(own.keys, own.counts)
        summary.undercount += own.undercount
        summary.merge()
    true = Counter(keys.tolist())
    assert {k for k, n in true.items() if n >= threshold} <= set(summary.at_least(threshold).tolist())
    assert len(summary.keys) <= summary.capacity and summary.undercount < threshold


def test_scores_beyond_64_bits(spark):
    import decimal
    a, n, left, rest = 9 * 10**11, 8 * 10**13, 3 * 10**12, 10**12
    df = spark.createDataFrame([(a, n, left, rest)], "a long, n long, l long, r long")
    assert df.select(collocations.cut_score().alias("s")).first()[0] == 1000 * a * n // (left * rest)
    assert decimal.Decimal(1000 * a * n) > 2**64
