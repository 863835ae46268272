"""Chat formatting by columnar byte assembly.

Turns arrive sorted by conversation.  For each Arrow batch the lengths of all
headers and contents, their cumulative offsets and the scatter indices are
computed in numpy, and every byte is copied once into one preallocated buffer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """A turn is open + role + close_role + text + end; role and text are escaped.

    An escape character is put after the first character of every control
    string in a text, and every escape character is doubled, so taking one
    escape character away before any other character gives the text again.
    """

    open: str = "<|im_start|>"
    close_role: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)
    breaks: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        if not {self.open, self.close_role, self.end} <= set(self.controls):
            raise ValueError("the template's own marks must be control strings")
        for c in self.controls:
            if len(c) < 2 or self.escape in c:
                raise ValueError(f"no control string: {c!r}")


def escape(texts: pa.Array, t: Template) -> pa.Array:
    """Texts in which no control string stands, reversibly."""
    out = pc.replace_substring(texts, t.escape, t.escape * 2)
    # Breaking one string can't make or hide another: each is broken after its first character, and a
    # second pass is only needed where strings overlap, so go on until none is left.
    while True:
        found = [c for c in t.controls if pc.any(pc.match_substring(out, c)).as_py()]
        if not found:
            return out
        for c in found:
            out = pc.replace_substring(out, c, c[0] + t.escape + c[1:])


def unescape(texts: pa.Array, t: Template) -> pa.Array:
    return pc.replace_substring_regex(texts, "(?s)" + ("\\\\" if t.escape == "\\" else t.escape) + "(.)", r"\1")


def _bytes_of(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string array."""
    a = a.cast(pa.large_binary())
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2] or b"", np.uint8)
    return data, offsets


def _scatter(out: np.ndarray, start: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy each segment data[offsets[i]:offsets[i+1]] to out[start[i]:]."""
    lengths = np.diff(offsets)
    total = int(lengths.sum())
    if total:
        first = int(offsets[0])
        shift = np.repeat(start - (offsets[:-1] - first), lengths)
        out[np.arange(total) + shift] = data[first : first + total]


def assemble(roles: pa.Array, texts: pa.Array, t: Template) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, turn offsets, content start, content end) for one batch of turns, all in bytes."""
    n = len(roles)
    names = roles.dictionary_encode()
    heads = pa.array([f"{t.open}{r}{t.close_role}" for r in escape(names.dictionary, t).to_pylist()], pa.large_string()).take(names.indices)
    parts = [_bytes_of(heads), _bytes_of(escape(texts, t)), _bytes_of(pa.array([t.end] * n, pa.large_string()))]
    lengths = np.stack([np.diff(o) for _, o in parts], 1)
    ends = np.cumsum(lengths.ravel()).reshape(n, 3)
    starts = ends - lengths
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for i, (data, offsets) in enumerate(parts):
        _scatter(out, starts[:, i], data, offsets)
    return out, np.concatenate([[0], ends[:, 2]]) if n else np.zeros(1, np.int64), starts[:, 1], ends[:, 1]


FORMATTED = "part long, n_turns int, formatted string, loss_start array<int>, loss_end array<int>"


def _parts(batches: Iterator[pa.RecordBatch], t: Template) -> Iterator[pa.RecordBatch]:
    """One row per conversation and batch: its turns there, in order; loss spans are in code points of the part."""
    last, part = object(), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0)
        out, offsets, begin, end = assemble(batch.column(1), batch.column(2), t)
        keys = conv.to_pylist()
        cuts = [0] + [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]] + [len(keys)]
        chars = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])  # code points before each byte
        learn = np.array([r in t.loss_roles for r in batch.column(1).to_pylist()])
        numbers, starts, ends = [], [], []
        for a, b in zip(cuts, cuts[1:]):
            part = part + 1 if keys[a] == last else 0
            last = keys[a]
            numbers.append(part)
            base, rows = chars[offsets[a]], np.flatnonzero(learn[a:b]) + a
            starts.append((chars[begin[rows]] - base).tolist())
            ends.append((chars[end[rows]] - base).tolist())
        at = pa.py_buffer(offsets[np.array(cuts)].astype(np.int64))
        text = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, at, pa.py_buffer(out)])
        yield pa.RecordBatch.from_arrays(
            [conv.take(pa.array(cuts[:-1])), pa.array(numbers, pa.int64()), pa.array(np.diff(cuts), pa.int32()), text.cast(pa.string()), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))],
            ["_conv", "part", "n_turns", "formatted", "loss_start", "loss_end"],
        )


def format_chats(turns: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, part, n_turns, formatted, loss_start, loss_end): the parts of a conversation, in order, are its text.

    A conversation is one part unless it crosses an Arrow batch, so one with any
    number of turns is formatted in bounded memory.  Loss spans are code points
    of the part's text: the contents of the loss roles, still escaped.  Turns of
    equal number are ordered by role and text (repeated rows all stay); a null
    turn number comes first; null texts and roles are empty; rows without a
    conversation id form one of their own; an empty table gives no rows; other
    columns are not read.  The result stays partitioned and sorted by
    conversation and part.
    """
    kind = turns.schema[conv_col].dataType.simpleString()
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_col).alias("_conv"), text(role_col).alias("_role"), text(text_col).alias("_text"), F.col(turn_col).alias("_turn"))
    dealt = rows.repartition("_conv").sortWithinPartitions("_conv", "_turn", "_role", "_text").select("_conv", "_role", "_text")
    return dealt.mapInArrow(lambda b: _parts(b, template), f"_conv {kind}, {FORMATTED}").withColumnRenamed("_conv", conv_col)


def read_turns(formatted: pa.Array, t: Template) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """(roles, texts, turns per string), parsed and unescaped from formatted strings."""
    turns = pc.split_pattern(formatted, t.end)  # the end mark stands nowhere else
    counts = np.array([len(x) - 1 for x in turns.to_pylist()], np.int64)
    flat = [x for row in turns.to_pylist() for x in row[:-1]]
    pairs = [x[len(t.open) :].split(t.close_role, 1) for x in flat]
    return unescape(pa.array([p[0] for p in pairs], pa.string()), t), unescape(pa.array([p[1] for p in pairs], pa.string()), t), counts


DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digest(formatted: DataFrame, template: Template = Template(), conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from format_chats' result: counts and hashes of its turns and of what the loss mask covers.

    It streams over the parts where they lie, so it needs no shuffle, and hashes
    long conversations part by part.
    """
    kind = formatted.schema[conv_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def flush(rows: list) -> pa.RecordBatch:
            cols = list(zip(*[(r[0], r[1], r[2].hexdigest(), r[3], r[4].hexdigest(), r[5]) for r in rows])) or [[]] * 6
            types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)], ["_conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            done, texts = [], batch.column(2)
            roles, contents, counts = read_turns(texts, template)
            roles, contents, at = roles.to_pylist(), contents.to_pylist(), 0
            masked = [[s[a:b] for a, b in zip(x, y)] for s, x, y in zip(texts.to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            for conv, part, text, n, mask in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts.to_pylist(), counts, masked):
                if state is None or part == 0:
                    if state is not None:
                        done.append(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += int(n)
                state[5] += len(text)
                state[2].update("".join(f"{r}\n{c}\n" for r, c in zip(roles[at : at + n], contents[at : at + n])).encode("utf-8"))
                at += int(n)
                for content in unescape(pa.array(mask, pa.string()), template).to_pylist():
                    state[3] += len(content)
                    state[4].update(content.encode("utf-8"))
            yield flush(done)
        if state is not None:
            yield flush([state])

    rows = formatted.select(F.col(conv_col).alias("_conv"), "part", "formatted", "loss_start", "loss_end")
    return rows.mapInArrow(run, f"_conv {kind}, {DIGEST}").withColumnRenamed("_conv", conv_col)
