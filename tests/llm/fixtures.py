"""Small tables with every awkward case, and brute-force helpers."""

import random
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SPACE = re.compile(r"[\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


def prose(seed, n=60, vocabulary=4000):
    rng = random.Random(seed)
    out = [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    return "\n".join(" ".join(out[i:i + 12]) for i in range(0, n, 12))


def edited(text, seed, edits):
    rng = random.Random(seed)
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def doc(i, text, lang="en", source="a"):
    return (i, text, lang, source, None if text is None else len(text))


def awkward():
    """Nulls in any column, empty and very long texts, ties, repeated rows, Unicode."""
    base = prose(1, 200)
    line = "This Boilerplate line is held by many documents, word for word."
    rows = [doc(1, None), doc(2, ""), doc(3, " \n\t "), doc(4, "one two"), doc(5, "one two"), doc(6, "One TWO three"),
            doc(7, base), doc(8, base), doc(8, base), doc(9, base.upper()), doc(None, base), doc(None, None),
            doc(10, "\n".join([prose(2, 40), line])), doc(11, "\n".join([line, prose(3, 40), line])),
            doc(12, prose(4, 30_000)), doc(13, prose(5, 100), None, None), doc(14, "ÀÉ Ünïcode Σας 中文 \x1f x " * 9)]
    rows += [doc(20 + i, f"{prose(30 + i, 40)}\n  {line.upper() if i % 2 else line}\t", source=None if i == 3 else "b")
             for i in range(7)]
    rows += [doc(40 + i, edited(base, i, 1 + 4 * i)) for i in range(8)]
    return rows


def extra_columns(df):
    """Columns whose names clash with what an operator might use inside."""
    from pyspark.sql import functions as F
    for c in ("id", "key", "a", "b", "n", "s", "pos", "size", "blob", "row", "length", "cls", "c", "conv", "rows"):
        df = df.withColumn(c, F.lit(c))
    return df


def shingle_set(text, size=5, tokens=None):
    w = words_of((text or "").translate(UPPER)) if tokens is None else tokens
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def classes(rows, num=75, den=100):
    """(id, text) rows -> component per row by all pairs: smallest non-null id reachable."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if inter and den * inter >= num * (len(sets[i]) + len(sets[j]) - inter):
                parent[find(i)] = find(j)
    out = []
    for i, (own, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((own, len(sets[i]), (min(ids) if ids else None) if sets[i] else own))
    return out
