"""Repair of conversations whose turns break the grammar `(s?(ua)+)?` of role initials.

A backward pass finds the cost to go from every turn and grammar state, a
forward walk takes, of the edits that reach it, the one of the smallest letter.
Both stream over one sorted pass: a conversation's turns come first without
their texts, one byte and one number each, then again with them.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import give_back

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
#: Costs that no edit reaches.
NEVER = 1 << 20
#: Grammar states: nothing yet, after system, after user, after assistant.
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
#: Where keeping a turn leads, by state and initial (s, u, a, other).
KEEP = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
#: Cost to go behind the last turn: what has to be inserted.
END = (0, 2 * INSERT, INSERT, 0)
#: Pairs of initials that may follow each other.
LEGAL = {(0, 1), (1, 2), (2, 1)}


@lru_cache(maxsize=1 << 14)
def _costs(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Cost to go before a turn, by state, from the one behind it; code: fault * 4 + initial."""
    fault, initial = divmod(code, 4)
    held = 0 if fault in (BLANK, DUPLICATE) else 1
    more = CUT_SHORT if fault == TRUNCATED else 0
    here = []
    for s in range(4):
        best = DELETE + after[s]
        if held:
            best = min(best, REROLE + more + after[NEXT[s]], more + after[KEEP[s, initial]] if (s, initial) in KEEP else NEVER)
        here.append(best)
    user, assistant = min(here[2], INSERT + here[3]), min(here[3], INSERT + here[2])
    return min(here[0], INSERT + user), min(here[1], INSERT + user), user, assistant


@lru_cache(maxsize=1 << 14)
def _back(code: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """(costs less their minimum, the minimum): few vectors occur, however long the conversation."""
    here = _costs(code, after)
    low = min(here)
    return tuple(c - low for c in here), low


@lru_cache(maxsize=1 << 16)
def _walk(code: int, after: tuple[int, ...], state: int) -> tuple[int, int, str, int]:
    """(inserts before the turn, state at it, its edit, state behind it): the tight edits of the smallest letters."""
    fault, initial = divmod(code, 4)
    here, more, inserts = _costs(code, after), CUT_SHORT if fault == TRUNCATED else 0, 0
    while True:
        if DELETE + after[state] == here[state]:
            return inserts, state, "D", state
        if INSERT + here[NEXT[state]] == here[state]:
            inserts, state = inserts + 1, NEXT[state]
            continue
        if (state, initial) in KEEP and more + after[KEEP[state, initial]] == here[state]:
            return inserts, state, "K", KEEP[state, initial]
        return inserts, state, "R", NEXT[state]


SUMMARY = "struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long>"
_SUMMARY = pa.struct([(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")])


class _Plan:
    """One conversation: what its turns say, then the edits, turn by turn."""

    def __init__(self, conv):
        self.conv = conv
        self.codes, self.counts, self.illegal, self.before = bytearray(), [0, 0, 0, 0], 0, None
        self.turns = [None, None, 0]
        self.ready = False

    def take(self, code: int, turn: int | None) -> None:
        fault, initial = divmod(code, 4)
        self.codes.append(code)
        self.counts[fault] += 1
        if self.before is not None and (self.before, initial) not in LEGAL:
            self.illegal += 1
        self.before = initial
        if turn is not None:
            if self.turns[0] is None:
                self.turns[0] = turn
            if turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]

    def solve(self) -> dict[str, int]:
        """The backward pass; gives the summary."""
        known, list_, after, total = {END: 0}, [END], END, 0
        self.after = array("H", bytes(2 * len(self.codes)))
        for i in range(len(self.codes) - 1, -1, -1):
            self.after[i] = known[after]
            after, low = _back(self.codes[i], after)
            total += low
            if after not in known:
                known[after] = len(list_)
                list_.append(after)
        self.vectors, self.at, self.state, self.seq, self.ready = list_, 0, 0, 0, True
        first, last, n = self.turns
        return {"gaps": last - first + 1 - n if n else 0, "blank": self.counts[BLANK], "duplicate": self.counts[DUPLICATE], "truncated": self.counts[TRUNCATED], "illegal": self.illegal, "cost": total + after[0]}

    def edits(self, role: str, text: str) -> Iterator[tuple[str, str | None, str | None]]:
        """(edit, role, text) up to the next turn, with this one's."""
        inserts, at, edit, to = _walk(self.codes[self.at], self.vectors[self.after[self.at]], self.state)
        yield from self.inserted(inserts)
        yield (edit, role, text) if edit == "K" else (edit, None, None) if edit == "D" else (edit, ROLE[at], text)
        self.at, self.state = self.at + 1, to

    def inserted(self, n: int) -> Iterator[tuple[str, str, str]]:
        for _ in range(n):
            yield "I", ROLE[self.state], ""
            self.state = NEXT[self.state]

    def last(self) -> Iterator[tuple[str, str, str]]:
        return self.inserted(END[self.state] // INSERT)


def _stream(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType, max_chars: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows of sorted conversations (conv, phase, code, turn, role, text): a summary of each, then its edits in order."""
    out: list[tuple] = []
    size, plan = 0, None

    def flush() -> pa.RecordBatch:
        nonlocal out, size
        cols = list(zip(*out)) or [()] * 6
        types = [conv_type, pa.int64(), _SUMMARY, pa.string(), pa.string(), pa.string()]
        out, size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["_conv", "seq", "summary", "edit", "role", "text"])

    def head() -> None:
        out.append((plan.conv, -1, plan.solve(), None, None, None))

    def put(edit: str, role: str | None, text: str | None) -> None:
        nonlocal size
        out.append((plan.conv, plan.seq, None, edit, role, text))
        plan.seq += 1
        size += 64 + len(text or "")

    def end() -> None:
        if not plan.ready:
            head()
        for e in plan.last():
            put(*e)

    for batch in batches:
        for conv, phase, code, turn, role, text in zip(*[batch.column(i).to_pylist() for i in range(6)]):
            if phase < 0:  # every conversation begins with one
                if plan is not None:
                    end()
                plan = _Plan(conv)
            elif phase == 0:
                plan.take(code, turn)
            else:
                if not plan.ready:
                    head()
                for e in plan.edits(role, text):
                    put(*e)
            if size > max_chars or len(out) > 20_000:
                yield flush()
    if plan is not None:
        end()
    yield flush()
    give_back()


def faults(turns: DataFrame) -> DataFrame:
    """turns (_conv, _turn, _role, _text) without texts, with their hash (_h1, _h2) and _code: the first fault * 4 + initial."""
    rows = turns.select(
        "_conv", "_turn", "_role", F.xxhash64("_text").alias("_h1"), F.xxhash64(F.lit(1), "_text").alias("_h2"), (~F.col("_text").rlike(r"[^\x20\x09-\x0D]")).alias("_blank"),
        (~F.col("_text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("_cut"),
    )
    again = F.row_number().over(W.partitionBy("_conv", "_role", "_h1", "_h2").orderBy("_turn")) > 1
    fault = F.when(F.col("_blank"), BLANK).when(F.col("_again"), DUPLICATE).when(F.col("_cut"), TRUNCATED).otherwise(0)
    first = F.substring("_role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    return rows.withColumn("_again", again).select("_conv", "_turn", "_role", "_h1", "_h2", "_again", (fault * 4 + initial).alias("_code"))


def repair(turns: DataFrame, everyone: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, seq, summary, edit, role, text): the cheapest edits of every conversation, in order.

    The row of seq -1 holds the summary; then a row per edit: Keep, Rerole,
    Delete (without role and text) or Insert; the rows but the deleted ones are
    the repaired conversation.  everyone: conversations (conv_id) that are
    listed even without turns.  Null roles and texts are one space; null turn
    numbers come first, equal ones are ordered by role, then by a hash of the
    text; repeated rows are duplicates; rows without a conversation id are one
    conversation; an empty table gives no rows; other columns are not read.  Texts
    of any length are passed through, and a conversation takes three bytes per
    turn of memory.  The result stays partitioned and sorted by conversation.
    """
    kind = turns.schema[conv_col].dataType.simpleString()
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(F.col(conv_col).alias("_conv"), F.col(turn_col).cast("long").alias("_turn"), space(role_col).alias("_role"), space(text_col).alias("_text"))
    ids = rows.select("_conv") if everyone is None else rows.select("_conv").unionByName(everyone.select(F.col(conv_col).alias("_conv")))
    begins = ids.distinct().select("_conv", F.lit(-1).alias("_phase"))
    told = faults(rows).withColumn("_phase", F.lit(0))
    texts = rows.select("_conv", F.lit(1).alias("_phase"), "_turn", "_role", F.xxhash64("_text").alias("_h1"), F.xxhash64(F.lit(1), "_text").alias("_h2"), "_text")
    all_ = begins.unionByName(told, allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
    dealt = all_.repartition("_conv").sortWithinPartitions("_conv", "_phase", "_turn", "_role", "_h1", "_h2", "_again").select("_conv", "_phase", "_code", "_turn", "_role", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            yield from _stream((b for part in ([first], batches) for b in part), first.schema.field(0).type)

    return dealt.mapInArrow(run, f"_conv {kind}, seq long, summary {SUMMARY}, edit string, role string, text string").withColumnRenamed("_conv", conv_col)


def digest(repaired: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, streamed over repair's result where it lies: its summary, the edits' letters and the hash of the repaired turns."""
    kind = repaired.schema[conv_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, type_ = None, None

        def flush(rows: list) -> pa.RecordBatch:
            cols = [[r[0] for r in rows], [r[1] for r in rows], ["".join(r[2]) for r in rows], [r[3].hexdigest() for r in rows]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (type_, _SUMMARY, pa.string(), pa.string()))], ["_conv", "summary", "audit", "repaired_sha256"])

        for batch in batches:
            type_, done = batch.schema.field(0).type, []
            for conv, seq, summary, edit, role, text in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                if seq < 0:
                    if state is not None:
                        done.append(state)
                    state = [conv, summary, [], hashlib.sha256(), ""]
                    continue
                state[2].append(edit)
                if len(state[2]) > 1 << 16:
                    state[2] = ["".join(state[2])]
                if edit != "D":
                    state[3].update(f"{state[4]}{role}:{text}".encode("utf-8"))
                    state[4] = "\n"
            yield flush(done)
        if state is not None:
            yield flush([state])

    rows = repaired.select(F.col(conv_col).alias("_conv"), "seq", "summary", "edit", "role", "text")
    out = rows.mapInArrow(run, f"_conv {kind}, summary {SUMMARY}, audit string, repaired_sha256 string")
    return out.select(F.col("_conv").alias(conv_col), *[F.col(f"summary.{c}").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], "audit", "repaired_sha256")
