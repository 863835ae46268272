"""Secret scanning: fixed patterns, and a character convolutional network for the rest.

The patterns give the base spans.  Every other token-like candidate is scored,
with the characters around it, by a small convolutional network in numpy that
is trained on the base findings of all documents, on all addresses there and on
made-up identifiers, paths, names and accessions that are none, all of them
strings that would be candidates; its threshold is the highest that keeps the
wanted recall on all of those held out of training.  A long candidate is scored
whole, in pieces, and the highest score counts.

Training is a round of Spark tasks per epoch: each block of the windows is gone
through by itself from the same weights, and what comes out is averaged.

A candidate is a run of 16 or more token characters that has a letter, and a
digit or a capital behind a small letter: digits alone are numbers, and plain
words have neither.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, sliced

#: Kinds in listed order; ties of start are sorted by it, and the network's kind comes last.
KINDS = ("assign", "access", "hex", "net")
_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: A candidate for the network: a run of token characters that isn't a number or a plain word.
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*[A-Za-z])(?=[A-Za-z0-9+/_=-]*?(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9+/_=-]{16,}")
#: Addresses, whose candidates are taken for no secrets.
_ADDRESS = re.compile(r"https?://[^\s\"'<>]{8,}|[A-Za-z0-9_.-]+@[A-Za-z0-9.-]+")
#: Words that must occur, in lower case, before the assign pattern is worth a try.
_KEYWORDS = ("pass", "secret", "token", "api")

#: Character classes that the network sees: every printable ASCII character, one for the rest, one for padding.
_PAD, _OTHER, _N_CLASSES = 0, 1, 97
#: Bytes of text that are Python's at once.
SLICE_BYTES = 8 << 20
#: Pieces of long candidates that are in memory at once.
PIECES = 4096
#: Logits are whole multiples of 1 / STEPS up to MOST, so counts of them tell all that a threshold needs.
STEPS, MOST = 1024, 64


@dataclass(frozen=True)
class NetParams:
    """How windows are spread (max_docs to made_up); the rest is shape and training.

    max_docs: None, as everywhere but in trials, takes every document.  One
    document in held_out, and as much of the made_up lines, isn't trained on but
    measured.  The made-up lines stand once beside every block windows, however
    many there are, in training and in measuring; there are at most max_blocks
    blocks, which grow beyond that.
    """

    max_docs: int | None = None
    block: int = 3_000
    max_blocks: int = 256
    held_out: int = 4
    made_up: int = 3_000
    value_chars: int = 48
    context_chars: int = 16
    embed: int = 8
    filters: int = 32
    width: int = 5
    epochs: int = 8
    rate: float = 0.01
    decay: float = 1e-4
    recall: float = 0.99
    seed: int = 11


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, sorted by start, then kind; code points, end exclusive."""
    found = []
    low = text.lower() if text.isascii() else text.translate(_LOWER)
    if any(k in low for k in _KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2])) if len(found) > 1 else found


_LOWER = {c: c + 32 for c in range(65, 91)}


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Token-like runs, as in the module's text, outside the base spans."""
    found = [m.span() for m in _CANDIDATE.finditer(text)]
    return [(a, b) for a, b in found if not any(s < b and a < e for _, s, e in taken)] if taken else found


def pieces(spans: list[tuple[int, int]], p: NetParams) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Spans of value_chars characters at most that cover each span, half over each other, and the number of the first of each."""
    out, first = [], []
    for a, b in spans:
        first.append(len(out))
        last = max(a, b - p.value_chars)
        out += [(s, min(b, s + p.value_chars)) for s in [*range(a, last, max(1, p.value_chars // 2)), last]]
    return out, np.array(first, np.intp)


def windows(text: str, spans: list[tuple[int, int]], p: NetParams) -> np.ndarray:
    """Class numbers of each span's first characters between its left and right context."""
    width = p.value_chars + 2 * p.context_chars
    out = np.zeros((len(spans), width), np.uint8)
    for row, (a, b) in zip(out, spans):
        left, mid, right = text[max(0, a - p.context_chars) : a], text[a : min(b, a + p.value_chars)], text[b : b + p.context_chars]
        for at, part in ((p.context_chars - len(left), left), (p.context_chars, mid), (p.context_chars + p.value_chars, right)):
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
            row[at : at + len(codes)] = np.where((codes >= 32) & (codes < 127), codes - 30, _OTHER)
    return out


class CharNet:
    """Embedding, one convolution, pooling by maximum and by mean, and a logistic output, in numpy.

    The maximum alone would take one odd pair of letters in an identifier for a
    secret; the mean tells how much of a string looks so.
    """

    def __init__(self, p: NetParams):
        rng = np.random.default_rng(p.seed)
        self.p = p
        self.w = {
            "e": rng.normal(0, 0.3, (_N_CLASSES, p.embed)), "k": rng.normal(0, 0.2, (p.width * p.embed, p.filters)),
            "b": np.zeros(p.filters), "v": rng.normal(0, 0.2, 2 * p.filters), "c": np.zeros(1),
        }
        self.m, self.s = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        self.step = 0.0
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5
        self.recall = self.precision = float("nan")  # on held-out documents, until calibrated
        self.trained_on = self.measured_on = 0  # distinct windows of documents

    def state(self) -> np.ndarray:
        """Weights, their moments and the number of steps, in one row."""
        return np.concatenate([*(part[k].ravel() for part in (self.w, self.m, self.s) for k in self.w), [self.step]])

    def restore(self, state: np.ndarray) -> None:
        at = 0
        for part in (self.w, self.m, self.s):
            for k, v in self.w.items():
                part[k] = state[at : at + v.size].reshape(v.shape)
                at += v.size
        self.step = float(state[at])

    def _forward(self, x: np.ndarray):
        e = self.w["e"][x]
        n, length, d = e.shape
        patches = np.lib.stride_tricks.sliding_window_view(e, self.p.width, axis=1).transpose(0, 1, 3, 2).reshape(n, length - self.p.width + 1, -1)
        h = np.maximum(patches @ self.w["k"] + self.w["b"], 0)
        top = h.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(h, top[:, None, :], 1)[:, 0, :], h.mean(axis=1)], 1)
        return patches, h, top, pooled, pooled @ self.w["v"] + self.w["c"][0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.concatenate([self._forward(x[i : i + 512])[4] for i in range(0, len(x), 512)]) if len(x) else np.zeros(0)
        return np.rint(np.clip(z, -MOST, MOST) * STEPS) / STEPS

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        return self._probabilities(self.logits(x))

    def _probabilities(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30)))

    def span_scores(self, text: str, spans: list[tuple[int, int]]) -> np.ndarray:
        """The highest score of each whole span's pieces, which are scored PIECES at a time."""
        parts, first = pieces(spans, self.p)
        scores = [self.scores(windows(text, parts[i : i + PIECES], self.p)) for i in range(0, len(parts), PIECES)]
        return np.maximum.reduceat(np.concatenate(scores), first) if len(first) else np.zeros(0)

    def epoch(self, x: np.ndarray, y: np.ndarray, number: int, block: int) -> None:
        """Once through the rows in an order of the epoch's and the block's own, from the present weights and moments on."""
        rng, p = np.random.default_rng([self.p.seed + 1, block]), self.p
        for _ in range(number + 1):
            order = rng.permutation(len(x))
        for i in range(0, len(order), 64):
            xb, yb = x[order[i : i + 64]], y[order[i : i + 64]]
            patches, h, top, pooled, z = self._forward(xb)
            dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - yb) / len(yb)
            most, mean = (dz[:, None] * v for v in np.split(self.w["v"], 2))
            dh = np.repeat(mean[:, None, :] / h.shape[1], h.shape[1], 1)
            np.put_along_axis(dh, top[:, None, :], np.take_along_axis(dh, top[:, None, :], 1) + most[:, None, :], 1)
            dh *= h > 0
            flat = dh.reshape(-1, p.filters)
            grad = {"v": pooled.T @ dz, "c": np.array([dz.sum()]), "b": flat.sum(0), "k": patches.reshape(len(flat), -1).T @ flat, "e": np.zeros_like(self.w["e"])}
            dp = (flat @ self.w["k"].T).reshape(len(xb), -1, p.width, p.embed)
            for k in range(p.width):
                at = xb[:, k : k + dp.shape[1]].ravel()
                grad["e"] += np.stack([np.bincount(at, dp[:, :, k, d].ravel(), _N_CLASSES) for d in range(p.embed)], 1)
            for k in ("k", "v"):
                grad[k] = grad[k] + p.decay * self.w[k]
            self.step += 1
            for k, g in grad.items():
                self.m[k] = 0.9 * self.m[k] + 0.1 * g
                self.s[k] = 0.999 * self.s[k] + 0.001 * g * g
                self.w[k] = self.w[k] - p.rate * (self.m[k] / (1 - 0.9**self.step)) / (np.sqrt(self.s[k] / (1 - 0.999**self.step)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """calibrate_counts on these rows."""
        self.calibrate_counts(self.logits(x), y, np.ones(len(y)))

    def calibrate_counts(self, z: np.ndarray, y: np.ndarray, n: np.ndarray) -> None:
        """Platt scaling on held-out logits z, of which each stands for n rows, then the highest threshold that keeps the wanted recall; recall and precision are those of the held-out rows there."""
        share = n / n.sum()
        a, b = 1.0, 0.0
        for _ in range(200):
            q = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            a -= 0.1 * float(share @ ((q - y) * z)) / (1 + float(share @ (z * z)))
            b -= 0.1 * float(share @ (q - y))
        self.scale, self.shift = max(a, 1e-3), b
        q, yes = self._probabilities(z), y > 0.5
        if yes.any():
            order = np.argsort(q[yes], kind="stable")
            upto = np.cumsum(n[yes][order])
            at = np.searchsorted(upto, int((1 - self.p.recall) * upto[-1]), "right")
            self.threshold = float(q[yes][order[at]]) - 1e-9
            found = q >= self.threshold
            self.recall, self.precision = float(n[found & yes].sum() / upto[-1]), float(n[found & yes].sum() / n[found].sum())


# Words, endings and abbreviations of program texts and file names, of which look-alikes are put together.
_TERMS = (
    "access action active address allocate archive argument array assign attribute backup balance batch binary block boolean branch browser bucket buffer bundle byte cache calendar callback capture catalog category change channel check class client cluster code column command comment commit compile complex connect context control count custom data debug decode define delete deploy detect device dictionary dispatch display document domain download dynamic element embed encode engine entry enum equal error escape event execute expand export factory failure feature fetch field file filter finish fix float folder format forward frame function future generic graph group handle hash header helper hidden hook host ignore image import index infer input install instance interval item join journal kernel keyboard label language layout library limit listener lock lookup machine manager matrix memory message method model module monitor mapping network node notify number object offset operator option order output overflow parse path pipeline plugin policy prefix process property proxy query queue reader record reduce regex request resolve result runtime sample schema search select server shuffle signal socket source split stack static stream struct subject symbol table target thread timestamp type update utility valid vector version view warning window wrapper write zone"
).split()
_ENDINGS = "s es ed er or ing ion able ment less ness ity ify ize al ive ous ful ward wise like".split()
_CAPS = "HTTP XML RPC URL URI JSON CSV SQL API CGI SSL TLS TCP UDP IPC IO OS UTF ASCII UUID SHA MD CPU GPU RAM DNS FTP SMTP HTML CSS PDF ZIP BZ GNU MIT JIS ISO RFC NCBI FASTA VCF DNA RNA CDS ORF HA NA NP PB".split()


def _word(rng: np.random.Generator) -> str:
    """A term, with an ending or without, or the halves of two, often with a letter changed or a few left out.

    What is odd in one place only is no secret yet, so look-alikes have odd places too.
    """
    term = lambda: _TERMS[rng.integers(len(_TERMS))]
    out = term()
    if rng.random() < 0.5:
        other = term()
        out = out[: len(out) // 2 + 1] + other[len(other) // 2 :]
    out += _ENDINGS[rng.integers(len(_ENDINGS))] if rng.random() < 0.3 else ""
    if rng.random() < 0.3:
        at = int(rng.integers(len(out)))
        out = out[:at] + chr(97 + int(rng.integers(26))) + out[at + 1 :]
    if rng.random() < 0.1:
        out = out[0] + "".join(c for c in out[1:] if c not in "aeiou")
    return out


def _look_alike(rng: np.random.Generator, i: int) -> str:
    """A candidate that is no secret: an identifier, a path, a file or strain name, an accession, a date, a setting or a UUID."""
    word = lambda: _word(rng)
    words = lambda lo, hi: [word() for _ in range(int(rng.integers(lo, hi)))]
    digits = lambda lo, hi: "".join(map(str, rng.integers(0, 10, int(rng.integers(lo, hi)))))
    caps = lambda k: "".join(chr(65 + c) for c in rng.integers(0, 26, k))
    title = lambda lo, hi: "".join(w.title() for w in words(lo, hi))
    hexes = lambda k: "".join("0123456789abcdef"[c] for c in rng.integers(0, 16, k))
    year = lambda: str(rng.integers(1950, 2030))
    short = lambda: _CAPS[rng.integers(len(_CAPS))]
    mixed = lambda: [short(), digits(1, 4), word(), word() + digits(1, 3), short() + digits(1, 3), "x" + digits(2, 3)][rng.integers(6)]
    forms = (
        lambda: title(2, 5),
        lambda: word() + title(2, 5),
        lambda: title(0, 2) + short() + title(1, 3),
        lambda: short() + short() + title(1, 4),
        lambda: "_" * int(rng.integers(1, 3)) + title(2, 5),
        lambda: "_".join([*words(1, 4), mixed(), *words(0, 3)]) + "_" + digits(1, 4),
        lambda: "_".join([*words(1, 4), mixed(), *words(1, 3)]).upper(),
        lambda: (short() + digits(1, 3) + "_" + "_".join(words(1, 4))).upper(),
        lambda: "-".join([*words(1, 4), mixed(), *words(0, 2)]) + "-" + year(),
        lambda: "/".join([*words(1, 5), mixed()]) + "/" + digits(1, 6),
        lambda: "/" * int(rng.integers(0, 2)) + "/".join(words(1, 5)) + "/" + title(2, 4),
        lambda: "/".join(words(2, 4)) + "/" + "_".join(words(1, 3)) + "_" + mixed() + digits(1, 3),
        lambda: word() + title(1, 3) + "=" + ["False", "True", "None", title(1, 3), digits(1, 5)][rng.integers(5)],
        lambda: "_".join(words(1, 3)) + "=" + "_" * int(rng.integers(0, 2)) + word() + title(1, 3),
        lambda: caps(int(rng.integers(2, 5))) + "_" + caps(int(rng.integers(2, 5))) + "_" + digits(5, 11),
        lambda: caps(int(rng.integers(1, 5))) + "_" + digits(10, 15),
        lambda: "/".join([["A", "B"][rng.integers(2)], word(), word().title(), digits(1, 5), year()]),
        lambda: word().title() + "-" + word() + "/" + word().title() + "/" + caps(2) + "-" + digits(2, 7) + "/" + year(),
        lambda: year() + "-" + digits(2, 3) + "-" + digits(2, 3) + "T" + digits(2, 3) + digits(2, 3) + "-" + word(),
        lambda: "img_" + digits(8, 9) + "_" + digits(6, 7),
        lambda: "ISBN-" + digits(13, 14),
        lambda: "-".join(hexes(k) for k in (8, 4, 4, 4, 12)),
        lambda: "v" + digits(1, 3) + "-" + digits(1, 3) + "-" + "-".join(words(2, 4)),
        lambda: "".join(words(2, 4)) + digits(1, 3),
        lambda: "abcdefghijklmnopqrstuvwxyz0123456789"[: int(rng.integers(27, 37))],
        lambda: "A-Za-z0-9+/_=-abcdefABCDEF0123456789"[: int(rng.integers(16, 37))],
    )
    while True:
        out = forms[i % len(forms)]()
        if _CANDIDATE.fullmatch(out):
            return out


def _around(rng: np.random.Generator) -> str:
    """Some 20 to 30 characters of prose or program text, to stand beside a value."""
    marks = (" ", " ", " ", "\n", "\n    ", "(", ")", "):\n", ", ", ": ", " = ", " == ", '"', "'", ".", "[", "]", "{", "}", "#", "*", "%", "<", ">", "&", "\\", "`", "@", " | ", "  ")
    prose, out = rng.random() < 0.4, ""
    while len(out) < 20:
        word = _word(rng)
        out += (word.title() if rng.random() < 0.2 else word) + (" " if prose else marks[rng.integers(len(marks))])
    return out


def _made_up(rng: np.random.Generator, n: int) -> list[tuple[str, int]]:
    """Labelled values beside the corpus, candidates all: n secrets of usual forms, and two look-alikes each."""
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    pick = lambda k, a=alnum: "".join(a[c] for c in rng.integers(0, len(a), k))
    forms = (
        lambda: "ghp_" + pick(36), lambda: "sk-" + pick(40), lambda: "xoxb-" + pick(11, alnum[52:]) + "-" + pick(24), lambda: "eyJ" + pick(60),
        lambda: pick(32), lambda: pick(40, alnum + "+/"), lambda: pick(int(rng.integers(18, 30))), lambda: pick(40, alnum[26:]), lambda: pick(int(rng.integers(20, 45)), alnum + "_-"),
    )
    out = []
    for i in range(n):
        value = forms[i % len(forms)]()
        while not _CANDIDATE.fullmatch(value):
            value = forms[i % len(forms)]()
        out += [(value, 1), (_look_alike(rng, 2 * i), 0), (_look_alike(rng, 2 * i + 1), 0)]
    return out


def _made_up_windows(rng: np.random.Generator, p: NetParams) -> list[tuple[int, np.ndarray]]:
    """(label, window) of the made-up values among prose and program text; a secret's pieces are secrets, a look-alike's are look-alikes."""
    edges = (" ", " ", "(", ")", '"', "'", "\n", ".", ",", ":", "[", "]", "<", ">", "`", "*", "{", "}", "@", "|")
    edge = lambda: edges[rng.integers(len(edges))]
    out = []
    for value, label in _made_up(rng, p.made_up):
        left = _around(rng) + edge()
        parts = pieces([(len(left), len(left) + len(value))], p)[0]
        out += [(label, x) for x in windows(left + value + edge() + _around(rng), parts, p)]
    return out


def _labelled(text: str | None, p: NetParams) -> list[tuple[int, bytes]]:
    """Windows of a text's base findings (1), and of pieces of its addresses (0), as far as they are candidates.

    A finding's keyword is taken out of its window: what the network scores has none.
    """
    if not text:
        return []
    spans, out = base_spans(text), []
    for kind, a, b in spans:
        at = _ASSIGN.match(text, a).start(2) if kind == "assign" else a
        if _CANDIDATE.fullmatch(text[at:b]):
            left = max(0, a - p.context_chars)
            out.append((1, windows(text[left:a] + text[at : b + p.context_chars], [(a - left, a - left + b - at)], p)[0].tobytes()))
    for m in _ADDRESS.finditer(text) if "@" in text or "://" in text else ():
        inside = [(m.start() + a, m.start() + b) for a, b in candidates(m.group(), [])]
        inside = [(a, b) for a, b in inside if not any(s < b and a < e for _, s, e in spans)]
        out += [(0, w.tobytes()) for w in windows(text, pieces(inside, p)[0], p)]
    return out


def labelled_windows(docs: DataFrame, p: NetParams, id_col: str, text_col: str) -> DataFrame:
    """(label, x, held) of all documents; held tells which side the document is on.

    With p.max_docs only those of the smallest id hashes are read.
    """
    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.col(text_col).alias("_text"))
    if p.max_docs is not None:
        ids = texts.select("_id").distinct().orderBy(F.xxhash64("_id"), "_id").limit(p.max_docs)
        texts = texts.join(F.broadcast(ids), "_id", "left_semi")  # at most p.max_docs ids
    held = (F.pmod(F.xxhash64("_id", F.lit(p.seed)), F.lit(p.held_out)) == 0).cast("int").alias("_held")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 0, SLICE_BYTES):
            found = [(*x, h) for t, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for x in _labelled(t, p)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.binary()), pa.array([x[2] for x in found], pa.int32())], ["label", "x", "held"])

    return texts.select("_text", held).mapInArrow(run, "label int, x binary, held int")


#: The name from when the documents were a sample.
sample_windows = labelled_windows


def _stacked(x: list[bytes], p: NetParams) -> np.ndarray:
    return np.frombuffer(b"".join(x), np.uint8).reshape(-1, p.value_chars + 2 * p.context_chars)


def _epoch(rows: DataFrame, blocks: int, net: CharNet, number: int, x: np.ndarray, y: np.ndarray) -> None:
    """One epoch: every block of rows, with x and y beside it, trained on from net's state; net gets the mean of what they reach.

    Sums are decimal, so they don't depend on the order in which blocks end.
    """
    p, start = net.p, net.state()

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        found = sorted((label, w) for label, w in zip(table.column("label").to_pylist(), table.column("x").to_pylist()) if w is not None)
        own = CharNet(p)
        own.restore(start)
        own.epoch(np.concatenate([_stacked([w for _, w in found], p), x]), np.concatenate([np.array([label for label, _ in found], float), y]), number, block)
        state = own.state()
        return pa.table([pa.array(np.arange(len(state), dtype=np.int32)), pa.array(state)], ["i", "value"])

    reached = rows.repartition(blocks, "block").groupBy("block").applyInArrow(run, "i int, value double")
    sums = reached.groupBy("i").agg(F.sum(F.col("value").cast("decimal(38,24)")).alias("total")).collect()  # a row per weight and moment
    net.restore(np.array([float(r["total"]) / blocks for r in sorted(sums, key=lambda r: r["i"])]))


def _held_logits(shown: DataFrame, net: CharNet) -> np.ndarray:
    """Columns label, logit and count of the held-out windows; at most 4 * MOST * STEPS + 2 rows, whatever the windows' number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = np.rint(net.logits(_stacked(batch.column(1).to_pylist(), net.p)) * STEPS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(z.astype(np.int32))], ["label", "z"])

    counts = shown.where("held = 1").select("label", "x").mapInArrow(run, "label int, z int").groupBy("label", "z").count().collect()
    return np.array(sorted((r["label"], r["z"] / STEPS, r["count"]) for r in counts), float).reshape(-1, 3).T


def train(docs: DataFrame, p: NetParams = NetParams(), id_col: str = "doc_id", text_col: str = "text") -> CharNet:
    """Fit on the windows of all documents, each window once, and on the made-up lines beside every block of them.

    The threshold, and CharNet.recall and .precision, come from all documents
    held out of training; windows that stand on both sides count as trained on.
    An empty table, or one without findings, uses the made-up lines alone.
    Row order and partitions don't matter.  The driver sees sums and counts only.
    """
    shown = materialize(labelled_windows(docs, p, id_col, text_col).groupBy("label", "x").agg(F.min("held").alias("held")), "labelled")
    made = _made_up_windows(np.random.default_rng(p.seed), p)
    x, y = np.stack([w for _, w in made]), np.array([label for label, _ in made], float)
    side = np.arange(len(made)) // 100 % p.held_out == 0
    net = CharNet(p)
    sizes = {r["held"]: r["count"] for r in shown.groupBy("held").count().collect()}
    net.trained_on, net.measured_on = sizes.get(0, 0), sizes.get(1, 0)
    blocks = min(max(1, -(-net.trained_on // p.block)), p.max_blocks)
    times = max(1, round(net.trained_on / (blocks * p.block)))
    rows = shown.where("held = 0").select(F.pmod(F.xxhash64("x"), F.lit(blocks)).cast("int").alias("block"), "label", "x")
    empty = docs.sparkSession.range(blocks).select(F.col("id").cast("int").alias("block"), F.lit(-1).alias("label"), F.lit(None).cast("binary").alias("x"))
    rows = rows.unionByName(empty)  # so that a block without windows still has the made-up lines
    for number in range(p.epochs):
        _epoch(rows, blocks, net, number, np.tile(x[~side], (times, 1)), np.tile(y[~side], times))
    label, z, n = _held_logits(shown, net)
    net.calibrate_counts(np.concatenate([z, net.logits(x[side])]), np.concatenate([label, y[side]]), np.concatenate([n, np.full(side.sum(), float(blocks * times))]))
    discard(shown)
    return net


def scan_text(text: str | None, net: CharNet | None) -> list[tuple[str, int, int]]:
    """All spans of one whole text: the base ones, and the candidates that the network accepts."""
    if not text:
        return []
    spans = base_spans(text)
    more = candidates(text, spans) if net is not None else []
    if more:
        score = net.span_scores(text, more)
        spans = sorted(spans + [("net", a, b) for (a, b), s in zip(more, score) if s >= net.threshold], key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return spans


SPANS = "array<struct<kind:string,start:int,end:int>>"


def scan(docs: DataFrame, net: CharNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) for each row of docs, in one pass without a shuffle.

    Null and empty texts have no spans; long texts are scanned whole; repeated
    rows are scanned each; an empty table gives no rows; other columns, whatever
    their names, are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in sliced(batches, 1, SLICE_BYTES):
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in scan_text(t, net)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, struct)], ["_id", "spans"])

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, spans {SPANS}").withColumnRenamed("_id", id_col)


def redact(docs: DataFrame, net: CharNet | None, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """docs with every span of text_col replaced by the mark, and n_chars, where there is one, counted anew.

    Overlapping spans become one mark; documents without a span, and null texts,
    stay as they are.  Repeated rows are treated alike, an empty table gives no
    rows, and other columns go through unread.
    """
    at = docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        spans = scan_text(text, net)
        if not spans:
            return text
        out, end = [], 0
        for _, a, b in spans:
            if a >= end:
                out += [text[end:a], mark]
            end = max(end, b)
        return "".join([*out, text[end:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, at, SLICE_BYTES):
            old = batch.column(at)
            cols = list(batch.columns)
            cols[at] = pa.array([clean(t) for t in old.to_pylist()], old.type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(text_col).isNotNull(), F.char_length(text_col)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out
