"""Line dedup, near dedup, decontamination, quality rules against brute force."""

import hashlib
from collections import Counter

import pytest

from stratum.llm import decontaminate, line_dedup, near_dedup, quality
from tests.llm import fixtures as fx


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fx.awkward(), fx.DOCS)


def rows(df, *cols):
    return sorted(map(repr, (tuple(r) for r in df.select(*cols).collect())))


def test_line_dedup(spark, docs):
    got = rows(line_dedup.dedup_lines(fx.extra_columns(docs)), "doc_id", "_n_lines", "_n_dropped", "_kept_text")
    data = fx.awkward()
    key = lambda x: x.strip(" \t\n\v\f\r").translate(fx.UPPER)
    holders = {}
    for i, t, *_ in data:
        for x in (t or "").split("\n"):
            holders.setdefault(key(x), set()).add(i)
    gone = {k: max(x for x in h if x is not None) for k, h in holders.items() if len(k) >= 40 and len(h) >= 5}
    want = []
    for i, t, *_ in data:
        split = (t or "").split("\n")
        kept = [x for x in split if key(x) not in gone or gone[key(x)] == i]
        want.append(repr((i, len(split), len(split) - len(kept), "\n".join(kept))))
    assert got == sorted(want)
    assert any(not r.endswith("0, ''") for r in got)


def test_near_duplicates_equal_all_pairs(spark, docs):
    got = near_dedup.near_duplicates(fx.extra_columns(docs)).select("doc_id", "_n_shingles", "_component", "_kept").collect()
    want = fx.classes([(i, t) for i, t, *_ in fx.awkward()])
    assert sorted(map(repr, ((r[0], r[1], r[2]) for r in got))) == sorted(map(repr, want))
    assert all(r["_kept"] == (r["doc_id"] == r["_component"]) for r in got)


def test_near_duplicates_of_a_large_group_with_weak_links(spark):
    """A base with copies of growing distance: many pairs lie around the limit."""
    base = fx.prose(9, 120)
    data = [(i, fx.edited(base, 100 + i, i % 14)) for i in range(150)]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    got = near_dedup.near_duplicates(df).select("doc_id", "_n_shingles", "_component").collect()
    assert sorted(tuple(r) for r in got) == sorted(fx.classes(data))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in near_dedup.components(edges).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and got[501] == 500


def test_decontamination(spark, docs):
    data = fx.awkward()
    passage = fx.prose(77, 40)
    planted = [fx.doc(60, f"{fx.prose(5, 3000)} {passage}, {fx.prose(6, 50)}"), fx.doc(61, passage.upper()),
               fx.doc(62, " ".join(passage.split()[:20]))]
    items = [(1, passage), (2, fx.prose(78, 50)), (3, None), (4, ""), (5, "one two"), (6, passage), (6, passage),
             (7, passage), (7, fx.prose(79, 8)), (None, passage)]  # one id, two texts
    df = spark.createDataFrame(data + planted, fx.DOCS)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.find_leaks(fx.extra_columns(df), fx.extra_columns(bench))
    tokens = lambda t: [w for w in __import__("regex").split(r"[^\p{L}\p{N}]+", (t or "").lower()) if w]
    want = []
    for i, t, *_ in data + planted:
        own = fx.shingle_set(t, tokens=tokens(t))
        for j in {j for j, _ in items}:
            s = frozenset().union(*[fx.shingle_set(u, tokens=tokens(u)) for k, u in items if k == j])
            if s and 100 * len(s & own) >= 75 * len(s):
                want.append(repr((i, j, len(s), len(s & own))))
    assert rows(got, "doc_id", "_item", "_item_shingles", "_matched") == sorted(want)
    shuffled = decontaminate.find_leaks(df, bench, broadcast_bytes=0)
    assert rows(shuffled, "doc_id", "_item", "_item_shingles", "_matched") == sorted(want)
    clean = decontaminate.decontaminate(df, bench)
    bad = {w.split(",")[0][1:] for w in want}
    assert {str(r["doc_id"]) for r in clean.collect()} == {str(i) for i, *_ in data + planted} - bad


def test_quality_figures():
    assert quality.base_figures(None) == (0, 0, 0, 0, 0)
    ten = " ".join(f"x{i}" for i in range(10))
    n, chars, symbols, dup, rep = quality.base_figures(f"{ten}\n{ten}\n#a\n\n\n#a")
    assert (n, chars, symbols, dup, rep) == (22, 44, 2, 2, 20)


def brute_quality_rows(data, max_docs=20):
    """(id, text, host) rows -> (removed words, base_failed, kept, kept text) per row, in a plain way."""
    strip = lambda x: x.strip(" \t\n\v\f\r").translate(fx.UPPER)
    rows = sorted(set(data), key=repr)
    n = {r: len(fx.words_of(r[1])) for r in rows}
    failed = {}
    for r in rows:
        w = fx.words_of(r[1])
        windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        hit = {i + j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(8)}
        failed[r] = n[r] < 20 or 100 * len(hit) > 30 * n[r]
    holders: dict = {}
    for r in rows:
        for x in (r[1] or "").split("\n"):
            if strip(x):
                holders.setdefault((r[2], strip(x)), []).append(r)
    common = {k: v for k, v in holders.items() if len({r[0] for r in v}) > max_docs}

    def without(r, keeper_of):
        return [x for x in (r[1] or "").split("\n") if (r[2], strip(x)) not in common or keeper_of((r[2], strip(x)), r)]

    left = {r: sum(len(fx.words_of(x)) for x in without(r, lambda k, r: False)) for r in rows}
    safe = {r: 100 * left[r] >= 30 * n[r] for r in rows}
    keeper = {k: max(((safe[r], r[0] is not None, r[0] or 0) for r in v if not failed[r]), default=None) for k, v in common.items()}
    mine = lambda k, r: keeper[k] is not None and keeper[k][1:] == (r[0] is not None, r[0] or 0)
    out = []
    for r in data:
        lines = without(r, mine)
        removed = n[r] - sum(len(fx.words_of(x)) for x in lines)
        keeps = any(mine(k, r) for k, v in common.items() if r in v)
        kept = not failed[r] and (keeps or 100 * (n[r] - removed) >= 30 * n[r])
        text = r[1] if len(lines) == len((r[1] or "").split("\n")) else "\n".join(lines)
        out.append((removed, failed[r], kept, text))
    return out


def brute_quality(data, max_docs=20):
    return sorted(repr((r[0], r[2], *got)) for r, got in zip(data, brute_quality_rows(data, max_docs)))


def rated(df, **kw):
    cols = ["doc_id", "source", "_removed_words", "_base_failed", "_kept", "_kept_text"]
    return sorted(repr(tuple(r)) for r in quality.quality_rules(fx.extra_columns(df), **kw).select(*cols).collect())


def test_quality_rules(spark):
    common = "a line that a whole host repeats on every page of it"  # 12 words
    own = [fx.doc(i, f"{common}\n{fx.prose(200 + i, 24 if i < 30 else 4)}", source="h") for i in range(40)]
    other = [fx.doc(100 + i, f"{common}\n{fx.prose(300 + i, 30)}", source="k") for i in range(5)]
    df = spark.createDataFrame(own + other + [fx.doc(200, None, None, None)], fx.DOCS)
    got = {r["doc_id"]: r for r in quality.quality_rules(fx.extra_columns(df)).collect()}
    # the largest id, 39, is too short to be kept, so 29 keeps the line
    assert all(got[i]["_removed_words"] == 12 for i in range(40) if i != 29) and got[29]["_removed_words"] == 0
    assert all(got[i]["_kept"] and (common in got[i]["_kept_text"]) == (i == 29) for i in range(30))
    assert not any(got[i]["_kept"] for i in range(30, 40))  # too short
    assert all(got[100 + i]["_kept"] and got[100 + i]["_removed_words"] == 0 for i in range(5))
    assert not got[200]["_kept"] and got[200]["_base_failed"]
    assert rated(df) == brute_quality([(i, t, s) for i, t, _, s, _ in own + other + [fx.doc(200, None, None, None)]])


def test_quality_rules_take_awkward_rows(spark, docs):
    data = [(i, t, s) for i, t, _, s, _ in fx.awkward()]
    assert rated(docs, max_docs=4) == brute_quality(data, 4)


def test_a_line_limit_is_the_same_at_every_host_size(spark):
    line = "one line of a footer that sixty documents of the host hold word for word"
    for others in (50, 3000):
        rows = [fx.doc(i, f"{line}\n{fx.prose(i, 30)}") for i in range(60)] + [fx.doc(100 + i, f"x{i} " * 25) for i in range(others)]
        got = quality.quality_rules(spark.createDataFrame(rows, fx.DOCS)).where("_removed_words > 0").count()
        assert got == 59


def test_every_removed_line_survives_in_a_kept_document(spark):
    line = "a page that holds nothing but this line is rejected by the base rules"
    depleted = " ".join(f"boiler{i}" for i in range(24))
    rows = [fx.doc(i, f"{line}\n{fx.prose(i, 30)}") for i in range(30)] + [fx.doc(99, line)]
    rows += [fx.doc(200 + i, depleted) for i in range(25)]
    kept = quality.quality_rules(spark.createDataFrame(rows, fx.DOCS)).where("_kept").collect()
    assert sum(line in r["_kept_text"] for r in kept) == 1
    assert [r["doc_id"] for r in kept if depleted in r["_kept_text"]] == [224]


@pytest.mark.parametrize("run", [
    lambda d: line_dedup.dedup_lines(d), lambda d: near_dedup.near_duplicates(d),
    lambda d: decontaminate.find_leaks(d, d.selectExpr("doc_id as item_id", "text")), lambda d: quality.quality_rules(d)])
def test_empty_table(docs, run):
    assert run(docs.limit(0)).count() == 0


def test_sha_of_an_empty_result(spark):
    df = spark.createDataFrame([(i, "the same long line of forty and more characters") for i in range(5)], "doc_id long, text string")
    got = {r["doc_id"]: r["_kept_text"] for r in line_dedup.dedup_lines(df).collect()}
    assert got[4] and not any(got[i] for i in range(4)) and hashlib.sha256(b"").hexdigest().startswith("e3b0")
