"""Conversation structure repair by a square-root checkpointed DP.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials. An
automaton of four states (start, after s, after u, after a) reads the rows; an
edit keeps a row (0), re-roles it to user or assistant (1), deletes it (2, forced
for blank and duplicate rows) or inserts an empty turn (5, anywhere); a truncated
row that is not deleted adds 5. The cost of the cheapest rest from every row and
state is a backward recurrence. Its vectors are stored at every sqrt(n)-th row
only; the walk forward recomputes one block at a time and takes, of the tight
edits (those on a cheapest path), the one with the smallest initial, which gives
the ASCII-least of the cheapest edit strings.

Scale: conversations of up to ``whole_rows`` rows and ``whole_bytes`` bytes are
streamed, sorted, through one task each. A larger one is cut by position into
blocks of at least sqrt(n) rows: every block gives the cost from each state
before it to each state after it, the blocks' matrices are chained backward to
the vectors at their ends (the checkpoints, at most sqrt(n) small rows), the blocks are
walked from every state to learn where they leave, and once more from the state
in which they are entered. All of this reads narrow columns; texts then pass
once, in order, beside the edits of their rows, so that a hot conversation needs
no memory that grows with it but for its audit, which the result holds anyway.

Defined cases: a null role or text is one space (so the row is blank or has no
legal role), and an empty role has no initial, so it is never legal; a null turn sorts first and is no turn number; rows of one turn are
ordered by role and text; a null conversation id is a conversation; repeated rows
are duplicates of each other; no rows give zeros, an empty audit and the hash of
the empty text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratum.operators.ordering import numbered_rows, placed, written
from stratum.llm.text import SPACE, hash128

# States and edit costs of the contract.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = (USER, USER, ASSISTANT, USER)  # where a re-roled or inserted turn leads
NAMED = ("user", "user", "assistant", "user")  # and its role
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEVER = 1 << 50
Vector = list[int]


def keeps(state: int, initial: str) -> int | None:
    """The state after a kept row, or None if its role is illegal there."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def _with_inserts(v: Vector) -> Vector:
    user, assistant = min(v[USER], INSERT + v[ASSISTANT]), min(v[ASSISTANT], INSERT + v[USER])
    return [min(v[START], INSERT + user), min(v[SYSTEM], INSERT + user), user, assistant]


END = _with_inserts([0, NEVER, NEVER, 0])

# A row of the DP: (initial of its role, must it go, is it truncated)
Row = tuple[str, bool, bool]


def before(row: Row, after: Vector) -> Vector:
    """Cheapest costs from before ``row``, insertions ahead of it included."""
    initial, gone, cut = row
    out = []
    for q in range(4):
        best = DELETE + after[q]
        if not gone:
            extra = TRUNCATED if cut else 0
            to = keeps(q, initial)
            if to is not None:
                best = min(best, extra + after[to])
            best = min(best, REROLE + extra + after[AFTER[q]])
        out.append(best)
    return _with_inserts(out)


def step(row: Row | None, q: int, here: Vector, after: Vector | None) -> tuple[str, int]:
    """(initials of the tight edits up to and with ``row``'s own, state after them). No row: the closing insertions."""
    edits = ""
    while True:
        if row is None:
            if here[q] == 0 and q in (START, ASSISTANT):
                return edits, q
            edits, q, cost = edits + "I", AFTER[q], INSERT
            here = END
            continue
        initial, gone, cut = row
        if here[q] == DELETE + after[q]:
            return edits + "D", q
        if here[q] == INSERT + here[AFTER[q]]:
            edits, q = edits + "I", AFTER[q]
            continue
        to = keeps(q, initial)
        if not gone and to is not None and here[q] == (TRUNCATED if cut else 0) + after[to]:
            return edits + "K", to
        return edits + "R", AFTER[q]


def walk(rows: list[Row], q: int, end: Vector) -> tuple[list[str], int]:
    """The edits of every row from state ``q`` before the first one, if the rest after the last costs ``end``,
    and the state after the last. Vectors are held at checkpoints sqrt(n) rows apart, and of one block."""
    n = len(rows)
    gap = isqrt(n) + 1
    checkpoints = {n: end}
    v = end
    for i in range(n - 1, -1, -1):
        v = before(rows[i], v)
        if i % gap == 0:
            checkpoints[i] = v
    pieces: list[str] = []
    for lo in range(0, n, gap):
        hi = min(lo + gap, n)
        block = [checkpoints[hi]]
        for i in range(hi - 1, lo - 1, -1):
            block.append(before(rows[i], block[-1]))
        for i in range(lo, hi):
            edits, q = step(rows[i], q, block[hi - i], block[hi - i - 1])
            pieces.append(edits)
    return pieces, q


def cheapest(rows: list[Row], end: Vector = END) -> Vector:
    for row in reversed(rows):
        end = before(row, end)
    return end


# --- rows of one conversation, in order --------------------------------------------

def fault(text: str, seen: bool) -> str:
    """blank, duplicate, truncated or none: the first that holds."""
    body = text.rstrip(SPACE)
    return "blank" if not body else "duplicate" if seen else "none" if body[-1] in ".!?" else "truncated"


class Summary:
    """Figures of a conversation, taken row by row."""

    def __init__(self):
        self.turns: list = [None, None, 0]  # least, greatest, distinct
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "none": 0}
        self.illegal, self.last = 0, None
        self.cost, self.audit = 0, []
        self.hash, self.empty, self.state = hashlib.sha256(), True, START

    def row(self, turn, role: str, kind: str) -> None:
        if turn is not None:
            if self.turns[0] is None:
                self.turns[0] = turn
            self.turns[2] += turn != self.turns[1]
            self.turns[1] = turn
        self.faults[kind] += 1
        if self.last is not None and self.last + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = role[:1]

    def apply(self, edits: str, role: str, text: str, kind: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the turns that ``edits`` keep, re-role or insert."""
        for e in edits:
            self.audit.append(e)
            if e == "I":
                out = (e, NAMED[self.state], "")
                self.state, self.cost = AFTER[self.state], self.cost + INSERT
            elif e == "D":
                self.cost += DELETE
                continue
            else:
                self.cost += (REROLE if e == "R" else 0) + (TRUNCATED if kind == "truncated" else 0)
                out = (e, role if e == "K" else NAMED[self.state], text)
                self.state = keeps(self.state, role[:1]) if e == "K" else AFTER[self.state]
            self.hash.update(f"{'' if self.empty else chr(10)}{out[1]}:{out[2]}".encode())
            self.empty = False
            yield out

    def close(self, conv) -> tuple:
        lo, hi, distinct = self.turns
        gaps = 0 if lo is None else hi - lo + 1 - distinct
        return (conv, gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"], self.illegal,
                self.cost, "".join(self.audit), self.hash.hexdigest())


FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_TYPES = [pa.int64()] * 6 + [pa.string()] * 2


def _whole(conv, rows: list[tuple]) -> tuple[tuple, list[tuple]]:
    """(figures, repaired turns) of a conversation held whole: (turn, role, text) in order."""
    seen: set = set()
    kinds, dp = [], []
    for _, role, text in rows:
        kinds.append(fault(text, (role, text) in seen))
        seen.add((role, text))
        dp.append((role[:1], kinds[-1] in ("blank", "duplicate"), kinds[-1] == "truncated"))
    pieces, q = walk(dp, START, END)
    tail = step(None, q, END, None)[0]
    summary, out = Summary(), []
    for (turn, role, text), kind, edits in zip(rows, kinds, pieces):
        summary.row(turn, role, kind)
        out += summary.apply(edits, role, text, kind)
    out += summary.apply(tail, "", "", "none")
    return summary.close(conv), out


def _emit(conv_type, turns: bool, figures: list[tuple], repaired: list[tuple]) -> pa.RecordBatch:
    if turns:
        cols, types = list(zip(*repaired)) or [[]] * 5, [conv_type, pa.int64(), *[pa.string()] * 3]
        names = ["conv", "position", "edit", "role", "text"]
    else:
        cols, types, names = list(zip(*figures)) or [[]] * 9, [conv_type, *_TYPES], ["conv", *FIGURES]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _short(batches: Iterable[pa.RecordBatch], turns: bool) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv, turn, role, text, lost): one conversation after the other."""
    conv, rows, open_ = None, [], False
    figures: list[tuple] = []
    repaired: list[tuple] = []

    def finish():
        line, out = _whole(conv, rows)
        figures.append(line)
        if turns:
            repaired.extend((conv, i, *t) for i, t in enumerate(out))

    kind = None
    for batch in batches:
        kind = batch.schema.field("conv").type
        for c, turn, role, text, lost in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if open_ and c != conv:
                finish()
                rows = []
            conv, open_ = c, True
            if not lost:
                rows.append((turn, role, text))
        if len(figures) >= 1000:
            yield _emit(kind, turns, figures, repaired)
            figures, repaired = [], []
    if open_:
        finish()
        yield _emit(kind, turns, figures, repaired)


def _streamed(batches: Iterable[pa.RecordBatch], turns: bool) -> Iterator[pa.RecordBatch]:
    """Sorted rows (start, at, conv, turn, role, text, kind, edits, tail) of large conversations, never held whole."""
    start, conv, summary, last_tail = None, None, None, ""
    kind_of, position = None, 0
    repaired: list[tuple] = []

    def close() -> pa.RecordBatch:
        nonlocal repaired, position
        for t in summary.apply(last_tail, "", "", "none"):
            repaired.append((conv, position, *t))
            position += 1
        line = summary.close(conv)
        batch, repaired = _emit(kind_of, turns, [line], repaired), []
        return batch

    for batch in batches:
        kind_of = batch.schema.field("conv").type
        for s, _, c, turn, role, text, kind, edits, tail in zip(*(batch.column(i).to_pylist() for i in range(9))):
            if s != start:
                if summary is not None:
                    yield close()
                start, conv, summary, position = s, c, Summary(), 0
            summary.row(turn, role, kind)
            for t in summary.apply(edits, role, text, kind):
                if turns:
                    repaired.append((conv, position, *t))
                    position += 1
            last_tail = tail
        if turns and repaired:
            yield _emit(kind_of, True, [], repaired)
            repaired = []
    if summary is not None:
        yield close()


# --- blocks of large conversations ---------------------------------------------------

_ROWS = ["initial", "gone", "cut"]


def _dp_rows(pdf: pd.DataFrame) -> list[Row]:
    return list(zip(pdf["initial"], pdf["gone"].astype(bool), pdf["cut"].astype(bool)))


def _matrix(key, pdf: pd.DataFrame) -> pd.DataFrame:
    rows = _dp_rows(pdf.sort_values("at"))
    cells = [cheapest(rows, [0 if q == e else NEVER for q in range(4)]) for e in range(4)]
    return pd.DataFrame([(*key, *[cells[e][q] for q in range(4) for e in range(4)])])


def _checkpoints(key, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("block", ascending=False)
    v, out = END, []
    for r in pdf.itertuples(index=False):
        out.append((key[0], r.block, *v))
        m = r[2:]
        v = [min(m[4 * q + e] + v[e] for e in range(4)) for q in range(4)]
    return pd.DataFrame(out)


def _exits(key, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("at")
    rows, end = _dp_rows(pdf), [int(pdf[f"v{e}"].iloc[0]) for e in range(4)]
    return pd.DataFrame([(*key, *[walk(rows, q, end)[1] for q in range(4)])])


def _entries(key, pdf: pd.DataFrame) -> pd.DataFrame:
    q, out = START, []
    for r in pdf.sort_values("block").itertuples(index=False):
        out.append((key[0], r.block, q))
        q = r[2 + q]
    return pd.DataFrame(out)


def _edits(key, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("at")
    pieces, q = walk(_dp_rows(pdf), int(pdf["entry"].iloc[0]), [int(pdf[f"v{e}"].iloc[0]) for e in range(4)])
    # what follows if the conversation ends here; only the last row's is used
    tail = step(None, q, END, None)[0]
    return pd.DataFrame({"start": key[0], "at": pdf["at"].to_numpy(), "edits": pieces, "tail": tail})


def _large(rows: DataFrame, sizes: DataFrame, block_rows: int, turns: bool, schema: str) -> DataFrame:
    """``rows`` (conv, turn, role, text) of the conversations of ``sizes``, by blocks."""
    at = placed(numbered_rows(rows, "repair-rows"),
                [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "_row"], "repair-placed").drop("_row")
    starts = written(at.groupBy(F.col("conv").alias("c")).agg(F.min("_at").alias("start"), F.count(F.lit(1)).alias("n")), "repair-starts")
    at = at.join(starts, F.col("conv").eqNullSafe(F.col("c"))).drop("c").withColumn("at", F.col("_at") - F.col("start"))
    width = F.greatest(F.lit(block_rows), F.ceil(F.sqrt("n"))).cast("long")
    at = at.withColumn("block", F.floor(F.col("at") / width).cast("long")).withColumn("h", hash128(F.col("role"), F.col("text")))
    first = (at.groupBy("start", "h").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("m")).where("m > 1")
               .select(F.col("start").alias("fs"), F.col("h").alias("fh"), "first"))
    seen = at.join(first, (F.col("start") == F.col("fs")) & (F.col("h") == F.col("fh")), "left")
    body = F.rtrim("text", F.lit(SPACE))
    kind = (F.when(body == "", "blank").when(F.col("first") < F.col("at"), "duplicate")
             .when(F.right(body, F.lit(1)).isin(".", "!", "?"), "none").otherwise("truncated"))
    known = written(seen.select("start", "at", "block", "conv", "turn", "role", "text", kind.alias("kind")), "repair-known")
    narrow = known.select("start", "block", "at", F.left("role", F.lit(1)).alias("initial"),
                          F.col("kind").isin("blank", "duplicate").alias("gone"), (F.col("kind") == "truncated").alias("cut"))
    key, vector = ["start", "block"], ", ".join(f"v{e} bigint" for e in range(4))
    cells = ", ".join(f"m{i} bigint" for i in range(16))
    matrices = narrow.groupBy(*key).applyInPandas(_matrix, f"start bigint, block bigint, {cells}")
    ends = written(matrices.groupBy("start").applyInPandas(_checkpoints, f"start bigint, block bigint, {vector}"), "repair-ends")
    exits = (narrow.join(ends, key).groupBy(*key)
                   .applyInPandas(_exits, "start bigint, block bigint, x0 bigint, x1 bigint, x2 bigint, x3 bigint"))
    entries = exits.groupBy("start").applyInPandas(_entries, "start bigint, block bigint, entry bigint")
    entered = written(ends.join(entries, key), "repair-entered")
    edits = (narrow.join(entered, key).groupBy(*key)
                   .applyInPandas(_edits, "start bigint, at bigint, edits string, tail string"))
    streamed = (known.join(edits, ["start", "at"])
                     .select("start", "at", "conv", "turn", "role", "text", "kind", "edits", "tail")
                     .repartition("start").sortWithinPartitions("start", "at"))
    return streamed.mapInArrow(lambda b: _streamed(b, turns), schema)


def _clean(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, lost: Column) -> DataFrame:
    return turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"), lost.alias("lost"))


def repair_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", lost_col: str | None = None, repaired_turns: bool = False,
                         whole_rows: int = 4096, whole_bytes: int = 1 << 26, block_rows: int = 1024) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conversation, or with
    ``repaired_turns`` the rows (conv, position, edit, role, text) of the repaired conversations.

    Rows with ``lost_col`` true are not there, but their conversation is."""
    lost = F.coalesce(F.col(lost_col), F.lit(False)) if lost_col else F.lit(False)
    rows = _clean(turns, conv_col, turn_col, role_col, text_col, lost)
    kind = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, " + ("position bigint, edit string, role string, text string" if repaired_turns else
                                 ", ".join(f"{c} bigint" for c in FIGURES[:6]) + ", audit string, repaired_sha256 string")
    there = ~F.col("lost")
    sizes = written(rows.where(there).groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b"))
                        .where((F.col("n") > whole_rows) | (F.col("b") > whole_bytes)).select(F.col("conv").alias("large")),
                    "repair-sizes")
    same = F.col("conv").eqNullSafe(F.col("large"))
    none_large = sizes.isEmpty()
    small = rows if none_large else rows.join(sizes, same, "left_anti")
    ordered = small.repartition("conv").sortWithinPartitions(
        F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    out = ordered.mapInArrow(lambda b: _short(b, repaired_turns), schema)
    if none_large:
        return out
    large = rows.where(there).join(sizes, same, "left_semi").drop("lost")
    return out.unionByName(_large(large, sizes, block_rows, repaired_turns, schema))


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """The contract's damage: (conv, turn, role, text, lost) by crc32 of ``conv:turn`` modulo 20."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), blank))
    d = (F.crc32(key) % 20).cast("int")
    text = F.coalesce(F.col(text_col), blank)
    return turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.when(d == 4, "user").otherwise(F.coalesce(F.col(role_col), blank)).alias("role"),
        F.when(d == 1, "").when(d == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (d == 0).alias("lost"), F.explode(F.when(d == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    ).drop("copy")
