"""The pipeline on a small corpus against brute force, and the SQL twins."""

import hashlib
import os
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from tests.llm import fixtures as fx
from tests.llm.test_text_operators import brute_quality_rows

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.001"


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    passage = fx.prose(500, 40)
    clean = [fx.doc(i, fx.prose(600 + i, 120), source=f"s{i % 3}") for i in range(30)]
    near = [fx.doc(100 + i, fx.edited(clean[0][1], i, 1)) for i in range(3)]
    leak = [fx.doc(200, f"{fx.prose(700, 100)}\n{passage}")]
    line = "a notice of well over forty characters that five documents hold"
    shared = [fx.doc(300 + i, f"{line}\n{fx.prose(800 + i, 60)}") for i in range(6)]
    junk = [fx.doc(400, "too short"), fx.doc(401, None), fx.doc(402, "again and again " * 40)]
    df = spark.createDataFrame(clean + near + leak + shared + junk, fx.DOCS)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "line_dedup":
            texts = {r["doc_id"]: r for r in docs.collect()}
            assert [line in texts[300 + i]["text"] for i in range(6)] == [False] * 5 + [True]
            assert all(r["n_chars"] == len(r["text"]) for r in texts.values())
    every = {r[0] for r in clean + near + leak + shared}
    assert seen[0] == every and seen[1] == every
    assert seen[2] == every - {100, 101, 102} and seen[3] == seen[2] - {200} and seen[4] == seen[3]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_quality_stage_leaves_a_copy_of_every_removed_line(spark):
    import corpus_pipeline
    from stratum.llm import quality

    line = " ".join(f"notice{k}" for k in range(15))
    template = [" ".join(f"t{k}x{j}" for j in range(12)) for k in range(6)]
    page = [fx.doc(i, f"{line}\n{fx.prose(900 + i, 60)}", source="h") for i in range(24)] + [fx.doc(99, line, source="h")]
    whole = [fx.doc(200 + i, "\n".join([*[t for k, t in enumerate(template) if k != i % 6], f"own{i}"]), source="t")
             for i in range(36)]
    junk = [fx.doc(300 + i, "nothing but a short line", source="j") for i in range(25)]
    repeated = [page[3], page[3], fx.doc(None, f"{line}\n{fx.prose(999, 60)}", source="h")]
    df = spark.createDataFrame(page + whole + junk + repeated, fx.DOCS)
    got = corpus_pipeline.quality_stage(spark, df, "").collect()
    held = lambda x, host: {r["doc_id"] for r in got if r["source"] == host and x in r["text"].split("\n")}
    assert held(line, "h") == {23}
    assert all(len(held(t, "t")) == 1 for t in template)
    assert not any(r["source"] == "j" for r in got)
    assert sum(r["source"] == "h" for r in got) == 27 and sum(r["source"] == "t" for r in got) == 2
    rated = quality.quality_rules(fx.extra_columns(df)).collect()
    assert len(rated) == df.count() and all(r["_removed_words"] == 15 for r in rated if r["doc_id"] in (3, None))


def test_near_dedup_stage_keeps_one_row_of_a_class(spark):
    import corpus_pipeline

    a, b, c, d, e = (fx.prose(40 + k, 120) for k in range(5))
    data = [fx.doc(1, a)] * 4 + [fx.doc(2, a)]  # one document ingested again and again
    data += [fx.doc(3, b), fx.doc(3, fx.edited(b, 1, 1)), fx.doc(3, c)]  # one id, two texts of a class, and another class
    data += [fx.doc(None, d)] * 3 + [fx.doc(None, fx.edited(d, 2, 1)), fx.doc(None, e), fx.doc(None, e)]  # null ids alone
    data += [fx.doc(9, None), fx.doc(9, None), fx.doc(None, " "), fx.doc(8, "")]  # no words
    df = spark.createDataFrame(data, fx.DOCS)
    got = corpus_pipeline.near_dedup_stage(spark, df, "").collect()
    worded = [(r["doc_id"], r["text"]) for r in got if (r["text"] or "").strip()]
    assert sorted(repr(i) for i, _ in worded) == ["1", "3", "3", "None", "None"]
    texts = {t for _, t in worded}
    assert len(texts) == 5 and {a, c, e} <= texts
    assert len(texts & {b, fx.edited(b, 1, 1)}) == 1 and len(texts & {d, fx.edited(d, 2, 1)}) == 1
    assert len(got) == 5 + 4


# --- every stage and the packed pieces, in a plain way ----------------------------------

def one_of_each_class(rows):
    """Row numbers that stay of (id, text) rows: per class that of smallest id, then text digest; rows without words stay."""
    sets = [fx.shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= 75 * (len(sets[i]) + len(sets[j]) - inter):
                parent[find(i)] = find(j)
    groups, kept = {}, []
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    for g in groups.values():
        if not sets[g[0]]:
            kept += g
        else:
            least = min((rows[i][0] for i in g if rows[i][0] is not None), default=None)
            kept.append(min((i for i in g if rows[i][0] == least), key=lambda i: hashlib.md5(rows[i][1].encode()).hexdigest()))
    return sorted(kept)


def by_hand(name, docs, items):
    """The rows (doc_id, text, lang, source, n_chars) that a stage keeps, or the pieces that packing makes."""
    strip = lambda x: x.strip(" \t\n\v\f\r").translate(fx.UPPER)
    with_text = lambda d, text: (d[0], text, d[2], d[3], d[4] if text == d[1] else len(text))
    if name == "quality_rules":
        got = brute_quality_rows([(d[0], d[1], d[3]) for d in docs])
        return [with_text(d, text) for d, (_, _, kept, text) in zip(docs, got) if kept]
    if name == "line_dedup":
        holders = {}
        for d in docs:
            for x in (d[1] or "").split("\n"):
                holders.setdefault(strip(x), set()).add(d[0])
        gone = {k: max(x for x in h if x is not None) for k, h in holders.items() if len(k) >= 40 and len(h) >= 5}
        out = []
        for d in docs:
            lines = (d[1] or "").split("\n")
            left = [x for x in lines if strip(x) not in gone or gone[strip(x)] == d[0]]
            if len(left) == len(lines) or fx.words_of("\n".join(left)):
                out.append(with_text(d, "\n".join(left)))
        return out
    if name == "minhash_near_dedup":
        return [docs[i] for i in one_of_each_class([(d[0], d[1]) for d in docs])]
    if name == "benchmark_decontamination":
        tokens = lambda t: [w for w in regex.split(r"[^\p{L}\p{N}]+", (t or "").lower()) if w]
        sets = [fx.shingle_set(t, tokens=tokens(t)) for _, t in items]
        own = [fx.shingle_set(d[1], tokens=tokens(d[1])) for d in docs]
        return [d for d, o in zip(docs, own) if not any(s and 100 * len(s & o) >= 75 * len(s) for s in sets)]
    tok, out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for d in docs:
        ids = np.asarray([*tok.encode(d[1] or "", add_special_tokens=False).ids, 0], "<u4")
        out += [(d[0], k, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes())) for k, at in enumerate(range(0, len(ids), 2048))]
    return out


def test_every_stage_equals_brute_force(spark, tmp_path):
    import corpus_pipeline

    passage, footer = fx.prose(501, 40), "a footer of more than forty characters that every page of the host carries"
    data = fx.awkward() + [fx.doc(100 + i, f"{fx.prose(900 + i, 60)}\n{footer}", source="h") for i in range(26)]
    data += [fx.doc(140 + i, f"{footer}\n{fx.prose(950 + i, 3)}", source="h") for i in range(4)]
    data += [fx.doc(150 + i, fx.edited(fx.prose(77, 150), i, 1 + i)) for i in range(6)] + [fx.doc(160, f"{fx.prose(5, 90)} {passage}")] * 2
    data += [fx.doc(None, fx.prose(88, 50)), fx.doc(170, fx.prose(88, 50)), fx.doc(171, fx.prose(89, 4000), None, None)]
    items = [(1, passage), (2, None), (None, fx.prose(502, 30))]
    df = spark.createDataFrame(data, fx.DOCS)
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, want, sizes = spark.read.parquet(f"{tmp_path}/documents.parquet"), data, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs, want = spark.read.parquet(f"{tmp_path}/{name}"), by_hand(name, want, items)
        cols = docs.columns if name != "best_fit_packing" else ["doc_id", "piece", "start", "length", "ids_crc32"]
        assert sorted(repr(tuple(r)) for r in docs.select(*cols).collect()) == sorted(map(repr, want)), name
        sizes.append(len(want))
    assert all(a > b for a, b in zip([len(data), *sizes], [sizes[0], *sizes[2:4]]))  # every filter but line dedup dropped some
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(repr((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in run) == sorted(map(repr, want))
    filled = {}
    for r in run:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in filled.values():
        ends = [a + n for a, n in sorted(parts)]
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048


@pytest.mark.slow
@pytest.mark.parametrize("name", ["op1_warc", "op2_decontamination", "op3_chat_formatting", "op6_line_dedup",
                                  "op8_near_dedup", "op9_quality_rules"])
def test_sql_twin(spark, name):
    from tests.harness import compare
    res = compare(spark, name, SF)
    assert res["ok"], res
