"""Personal data by a semi-Markov conditional random field.

Text around digits and @ signs is cut into atoms. Every run of up to MAX_ATOMS atoms is a candidate segment that whole-span
features score for each kind (digits, Luhn sum, valid address parts, shape, neighbours). Dynamic programming over segments of
bounded length chooses boundaries and kinds jointly; training follows the gradient of the exact conditional likelihood.

Fixed patterns give the base spans, which always stay and which the model learns from; the model adds spans beside them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: In the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 24
#: Characters around a digit or @ that belong to its island of text.
MARGIN = 40
#: Islands that a model is fitted on at most; those with the smallest hashes of the whole table are taken.
TRAIN_ISLANDS = 1200
EPOCHS = 5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A failed match at the start of a run of digits fails at its other digits too, so only starts of runs are tried.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ATOM = re.compile(r"[A-Za-z]+|[0-9]+|[\x20\t\r\n]+|[^A-Za-z0-9]")
_TRIGGER = re.compile(r"[0-9@]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if k % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _address(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the fixed patterns, leftmost and non-overlapping per kind; linear in the text's length."""
    found, at, end = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            found.append((start, 0, end))
        else:
            end = max(end, at + 1)  # nothing that holds this @ can match, nor reach beyond it to the left
        at = text.find("@", max(at + 1, end))
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _address(m[0])]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return sorted(found)


def islands(text: str) -> list[tuple[int, int]]:
    """Stretches around digits and @ signs, widened to white space where that is near; they don't overlap."""
    spans: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if spans and a <= spans[-1][1]:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    out = []
    for k, (a, b) in enumerate(spans):
        space = text.find(" ", a, min(a + 20, b))
        a = a if a == 0 or space < 0 else space
        space = text.rfind(" ", max(a, b - 20), b)
        out.append((a, b if b == len(text) or space < 0 else space))
    return out


_DIGIT, _LETTER, _SPACE, _OTHER = range(4)
_MARKS = {c: k for k, c in enumerate("@.+-()")}


class Atoms:
    """Atoms of a stretch of text with running counts, from which features of segments are read."""

    def __init__(self, text: str):
        found = [(m.start(), m.end()) for m in _ATOM.finditer(text)]
        self.text = text
        self.starts = np.array([a for a, _ in found], np.int64)
        self.ends = np.array([b for _, b in found], np.int64)
        n = len(found)
        self.kind = np.empty(n, np.int64)
        counts = np.zeros((n, 10), np.int64)  # digits, @ . + - ( ), letters, spaces, others
        for k, (a, b) in enumerate(found):
            c = text[a]
            if c in "0123456789":
                self.kind[k] = _DIGIT
                counts[k, 0] = b - a
            elif c in " \t\r\n":
                self.kind[k] = _SPACE
                counts[k, 8] = 1
            elif c.isascii() and c.isalpha():
                self.kind[k] = _LETTER
                counts[k, 7] = 1
            else:
                self.kind[k] = _OTHER
                counts[k, 1 + _MARKS[c] if c in _MARKS else 9] = 1
        self.sums = np.vstack([np.zeros((1, 10), np.int64), np.cumsum(counts, 0)])

    def __len__(self) -> int:
        return len(self.kind)


N_FEATURES = 42


def features(atoms: Atoms, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(ends x lengths x features, which segments may be entities) of the segments that end at atoms low < e <= high."""
    ends = np.arange(low + 1, high + 1)[:, None]
    begins = ends - np.arange(1, MAX_ATOMS + 1)[None, :]
    real = begins >= 0
    b = np.maximum(begins, 0)
    e = np.broadcast_to(ends, b.shape)
    d, at, dot, plus, dash, left, right, letters, spaces, others = np.moveaxis(atoms.sums[e] - atoms.sums[b], 2, 0)
    kind = atoms.kind
    first, last = kind[b], kind[e - 1]
    before = np.where(b > 0, kind[np.maximum(b - 1, 0)], _SPACE)
    after = np.where(e < len(kind), kind[np.minimum(e, len(kind) - 1)], _SPACE)
    plus_first = (atoms.sums[b + 1] - atoms.sums[b])[:, :, 3] == 1
    may = real & ((d > 0) | (at > 0)) & (first != _SPACE) & (last != _SPACE) & ((first != _OTHER) | plus_first | (left > 0))
    size = e - b
    address, sums_up = np.zeros(b.shape, bool), np.zeros(b.shape, bool)
    for i, j in zip(*np.nonzero(may & (size == 7) & (dot == 3) & (letters == 0) & (d >= 4) & (d <= 12)), strict=True):
        address[i, j] = _address(atoms.text[atoms.starts[b[i, j]] : atoms.ends[e[i, j] - 1]])
    plain = (letters == 0) & (at == 0) & (dot == 0) & (plus == 0) & (left == 0) & (right == 0) & (others == 0)
    for i, j in zip(*np.nonzero(may & plain & (d >= 12) & (d <= 19) & (first == _DIGIT) & (last == _DIGIT)), strict=True):
        piece = atoms.text[atoms.starts[b[i, j]] : atoms.ends[e[i, j] - 1]]
        sums_up[i, j] = luhn("".join(c for c in piece if "0" <= c <= "9"))
    solid = spaces == 0
    dialled = (letters == 0) & (at == 0) & (others == 0) & (d >= 9) & (d <= 15) & (last == _DIGIT)
    cells = [
        np.ones(b.shape, bool), d == 0, (d >= 1) & (d <= 3), (d >= 4) & (d <= 8), (d >= 9) & (d <= 15), (d >= 12) & (d <= 19), d > 19,
        at == 1, at > 1, dot == 0, dot == 3, dot > 3, address, sums_up, plus_first, plus > plus_first,
        first == _DIGIT, first == _LETTER, last == _DIGIT, last == _LETTER, last == _OTHER, letters == 0, (letters > 0) & (at == 0), others > 0,
        solid, (spaces > 0) & (spaces <= 3), spaces > 3, before == _SPACE, before <= _LETTER, after == _SPACE, after <= _LETTER,
        left > 0, dash > 0, plain, size <= 3, (size > 3) & (size <= 8), size > 8,
        (at == 1) & (dot >= 1) & solid & (others == 0) & (left + right == 0) & (last <= _LETTER), dialled & plus_first & (plus == 1),
        dialled & (left == 1) & (right == 1) & (dash > 0) & (plus == 0) & (first == _DIGIT), dialled & (left == 1) & (plus == 0) & (first == _OTHER),
        address & (before != _DIGIT) & (after != _DIGIT),
    ]
    return np.stack(cells, 2).astype(np.float32), may


@dataclass
class Model:
    """Weights of features by kind, of a single atom outside, and of transitions (outside, then the kinds)."""

    weights: np.ndarray
    outside: float
    moves: np.ndarray

    def scores(self, atoms: Atoms, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cells, may = features(atoms, low, high)
        return np.where(may[:, :, None], cells @ self.weights, -np.inf), cells, may

    def decode(self, text: str, block: int = 512) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the best segmentation, in characters of ``text``."""
        atoms = Atoms(text)
        n, k = len(atoms), len(KINDS) + 1
        best = np.full((n + 1, k), -np.inf)
        best[0, 0] = 0
        into = np.full((n + 1, k), -np.inf)  # best score before a segment of each kind begins
        into[0] = best[0, 0] + self.moves[0]
        length = np.zeros((n + 1, k), np.int64)
        for low in range(0, n, block):
            high = min(n, low + block)
            scores, _, _ = self.scores(atoms, low, high)
            for e in range(low + 1, high + 1):
                width = min(MAX_ATOMS, e)
                total = into[e - width : e][::-1, 1:] + scores[e - low - 1, :width]
                pick = total.argmax(0)
                best[e, 1:] = total[pick, np.arange(k - 1)]
                length[e, 1:] = pick + 1
                best[e, 0] = into[e - 1, 0] + self.outside
                length[e, 0] = 1
                into[e] = (best[e][:, None] + self.moves).max(0)
        found, e = [], n
        label = int(best[n].argmax())
        while e > 0:
            b = e - int(length[e, label])
            if label:
                found.append((int(atoms.starts[b]), label - 1, int(atoms.ends[e - 1])))
            e, label = b, int((best[b] + self.moves[:, label]).argmax())
        return found[::-1]


def _training(text: str) -> list[tuple[Atoms, list[tuple[int, int, int]]]]:
    """The island with its base spans in atoms; and, if it has a phone, a copy without the plus sign, still a phone."""
    examples = []
    spans = base_spans(text)
    variants = [(text, spans)]
    for start, kind, end in spans:
        if kind == 3 and "(" in text[start:end]:
            move = lambda x: x - (x > start)  # noqa: E731, B023
            variants.append((text[:start] + text[start + 1 :], sorted((move(a), k, move(b)) for a, k, b in spans)))
            break
    for piece, marked in variants:
        atoms = Atoms(piece)
        begins, ends = {int(a): i for i, a in enumerate(atoms.starts)}, {int(b): i + 1 for i, b in enumerate(atoms.ends)}
        gold, last = [], 0
        for a, k, b in marked:
            if a in begins and b in ends and begins[a] >= last and ends[b] - begins[a] <= MAX_ATOMS:
                gold.append((begins[a], k + 1, last := ends[b]))
        examples.append((atoms, gold))
    return examples


def fit(texts: list[str], epochs: int = EPOCHS, rate: float = 0.3, ridge: float = 1e-4, seed: int = 7) -> Model:
    """A model of the base spans of ``texts`` (islands), by adaptive gradient steps on the conditional likelihood."""
    k = len(KINDS) + 1
    model = Model(np.zeros((N_FEATURES, k - 1)), 0.0, np.zeros((k, k)))
    model.weights[0] = -2.0
    speed = [np.full(model.weights.shape, 1e-2), 1e-2, np.full((k, k), 1e-2)]
    examples = [x for t in texts for x in _training(t) if 0 < len(x[0]) <= 400]
    ready = [(features(atoms, 0, len(atoms)), gold) for atoms, gold in examples]
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(ready)):
            (cells, may), gold = ready[i]
            steps = _gradient(model, cells, may, gold)
            for name, j in (("weights", 0), ("outside", 1), ("moves", 2)):
                step = steps[j] - ridge * getattr(model, name)
                speed[j] = speed[j] + step * step
                setattr(model, name, getattr(model, name) + rate * step / np.sqrt(speed[j]))
    return model


def _sum(x: np.ndarray, axis=None) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _gradient(model: Model, cells: np.ndarray, may: np.ndarray, gold: list[tuple[int, int, int]]):
    """Observed minus expected counts of features, outside atoms and moves, by forward and backward sums."""
    n, k = len(cells), len(KINDS) + 1
    scores = np.where(may[:, :, None], cells @ model.weights, -np.inf)
    ahead = np.full((n + 1, k), -np.inf)
    ahead[0, 0] = 0
    into = np.full((n + 1, k), -np.inf)
    into[0] = model.moves[0]
    for e in range(1, n + 1):
        width = min(MAX_ATOMS, e)
        ahead[e, 0] = into[e - 1, 0] + model.outside
        ahead[e, 1:] = _sum(into[e - width : e][::-1, 1:] + scores[e - 1, :width], 0)
        into[e] = _sum(ahead[e][:, None] + model.moves, 0)
    back = np.full((n + 1, k), -np.inf)
    back[n] = 0
    start = np.full((n + 1, k), -np.inf)  # of segments of each kind that begin here
    for b in range(n - 1, -1, -1):
        width = min(MAX_ATOMS, n - b)
        lengths = np.arange(width)
        start[b, 0] = model.outside + back[b + 1, 0]
        start[b, 1:] = _sum(scores[b + lengths, lengths] + back[b + 1 : b + 1 + width, 1:], 0)
        back[b] = _sum(model.moves + start[b][None, :], 1)
    total = _sum(ahead[n])
    ends = np.arange(n)[:, None]
    begins = ends - np.arange(MAX_ATOMS)[None, :]
    expected = np.where(may[:, :, None], np.exp(into[np.maximum(begins, 0)][:, :, 1:] + scores + back[1:, None, 1:] - total), 0)
    weights = -np.einsum("elf,elk->fk", cells, expected)
    outside = -np.exp(into[:-1, 0] + model.outside + back[1:, 0] - total).sum()
    moves = -np.exp(ahead[:-1, :, None] + model.moves[None] + start[:-1, None, :] - total).sum(0)
    label, at = 0, 0
    for b, kind, e in [*gold, (n, -1, n)]:
        if b > at:
            outside += b - at
            moves[label, 0] += 1
            moves[0, 0] += b - at - 1
            label = 0
        if kind > 0:
            weights[:, kind - 1] += cells[e - 1, e - b - 1]
            moves[label, kind] += 1
            label, at = kind, e
    return weights, outside, moves


def sample_islands(docs: DataFrame, limit: int = TRAIN_ISLANDS) -> list[str]:
    """At most ``limit`` islands of the whole table, of at most 400 characters, those with the smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [t[a:b] for t in batch.column("text").to_pylist() for a, b in islands(t) if b - a <= 400]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["island"])

    rows = docs.select(F.col("text").cast("string").alias("text")).filter(F.col("text").rlike("[0-9@]")).mapInArrow(run, "island string")
    rows = rows.select("island", F.xxhash64("island").alias("h")).distinct().orderBy("h", "island").limit(limit)
    return [r["island"] for r in rows.collect()]


def find(text: str, model: Model) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, spans that the model adds), each (start, kind, end)."""
    if not _TRIGGER.search(text):
        return [], []
    base, added = base_spans(text), []
    k = 0
    for a, b in islands(text):
        for start, kind, end in model.decode(text[a:b]):
            start, end = start + a, end + a
            while k < len(base) and base[k][0] < start and base[k][2] <= start:
                k += 1
            if not any(x < end and start < y for x, _, y in base[max(0, k - 4) : k + 8]):
                added.append((start, kind, end))
    return base, added


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), n_added.

    Spans are kind:start:end in code points, by start and kind, joined by commas. A null text is an empty one; repeated rows
    stay.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = rows.select("doc_id").schema
    for kind in KINDS:
        schema = schema.add(f"n_{kind}", "long")
    schema = schema.add("base_sha256", "string").add("spans", "string").add("n_added", "long")
    names = schema.fieldNames()
    packed = docs.sparkSession.sparkContext.broadcast((model.weights, model.outside, model.moves))
    spell = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*packed.value)
        for batch in batches:
            counts = np.zeros((len(batch), len(KINDS)), np.int64)
            digests, spans, more = [], [], []
            for i, text in enumerate(batch.column("text")):
                base, added = find(text.as_py(), model)
                for _, kind, _ in base:
                    counts[i, kind] += 1
                digests.append(hashlib.sha256(spell(base).encode()).hexdigest())
                spans.append(spell(sorted([*base, *added])))
                more.append(len(added))
            columns = [pa.array(counts[:, k]) for k in range(len(KINDS))]
            arrays = [batch.column("doc_id"), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(more, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, schema)


def fit_and_scan(docs: DataFrame) -> DataFrame:
    """``scan`` with a model that is fitted on a bounded sample of the same documents."""
    return scan(docs, fit(sample_islands(docs)))
