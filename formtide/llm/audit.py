"""Audit of how filters interact, by contractions of contingency tensors.

Every document has one bit per filter, pass or fail. Per part, the documents with each combination of bits are counted into a
tensor of shape 2 x 2 x 2 x 2 x 2, for all documents and for the labelled good and toxic ones. Whatever a sequence of filters
does to a part follows from that tensor: each step of each order selects pass, fail or all along every axis, and one einsum
contracts all steps at once. So 120 orders cost one pass over the documents and some hundred numbers a part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formtide.llm.common import text_of
from formtide.llm.tokens import buffers, slices
from formtide.session import materialize

FILTERS = "ABCDE"
#: Bounds of the filters: words, percent of distinct words, percent of capitals.
MIN_WORDS = 200
MIN_DISTINCT = 50
MAX_UPPER = 2
_SYMBOLS = re.compile(rb"[#$%&*|]")
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: Bytes that are split into words at a time.
SEGMENT = 1 << 20

_PASS, _FAIL, _ALL = (1, 0), (0, 1), (1, 1)
ORDERS = ["".join(p) for p in permutations(FILTERS)]


def _words(text: bytes) -> tuple[int, int]:
    """(words, distinct words), holding no more than a segment's words and the distinct ones."""
    count, kinds, at = 0, set(), 0
    while at < len(text):
        gap = _SPACE.search(text, at + SEGMENT)
        end = gap.start() if gap else len(text)
        words = text[at:end].split()  # bytes split at the same six characters
        count += len(words)
        kinds.update(words)
        at = end
    return count, len(kinds)


def own_failures(text: bytes, chars: int) -> int:
    """Bits of the filters A to D, which need nothing but the text."""
    count, kinds = _words(text)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (count < MIN_WORDS)
        | (100 * kinds < MIN_DISTINCT * count) << 1
        | (100 * capitals > MAX_UPPER * chars) << 2
        | (_SYMBOLS.search(text) is not None) << 3
    )


def failures(docs: DataFrame) -> DataFrame:
    """(part, bits, text_key, doc_id) per row: the source, bits of A to D, and a digest that stands for the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = buffers(batch.column("text"))
            first, ends = (data & 0xC0) != 0x80, offsets.tolist()  # the first byte of each code point
            bits = [
                own_failures(data[a:b].tobytes(), int(np.count_nonzero(first[a:b]))) for a, b in zip(ends[:-1], ends[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(bits, pa.int32())], [*kept, "bits"])

    kept = ["doc_id", "part", "text_key"]
    text = text_of()
    rows = docs.select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("text_key"), text.alias("text")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, part string, text_key binary, bits int")


def contingency(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, docs, good, toxic): documents with each combination of failures, in all and of those labelled.

    A document fails E if a smaller doc_id has its text. Rows are first counted by id, where the labels join, then by text, so
    however many copies a text has, one row a task and part goes on to the place where its smallest id is found.
    """
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = failures(docs)
    by_id = rows.groupBy("doc_id", "text_key", "part", "bits").agg(F.count("*").alias("n")).join(marks, "doc_id", "left")
    flags = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    group = ["text_key", "part", "bits", "good", "toxic"]
    known = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    by_text = by_id.select("doc_id", "text_key", "part", "bits", "n", *flags).groupBy(*group)
    by_text = by_text.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("unnamed"), F.min(known).alias("own"))
    by_text = materialize(by_text, "texts")
    first = by_text.groupBy("text_key").agg(F.min("own.doc_id").alias("first"))
    # Passing E: rows with the smallest id of their text, and rows without an id, which is smaller or larger than none.
    passing = F.coalesce("unnamed", F.lit(0)) + F.when(F.col("own.doc_id") == F.col("first"), F.col("own.n")).otherwise(F.lit(0))
    split = F.array(
        F.struct(F.col("bits").alias("bits"), passing.alias("n")), F.struct((F.col("bits") + 16).alias("bits"), (F.col("n") - passing).alias("n"))
    )
    cells = by_text.join(first, "text_key").select("part", "good", "toxic", F.explode(split).alias("cell"))
    counts = cells.groupBy("part", F.col("cell.bits").alias("bits")).agg(
        F.sum("cell.n").alias("docs"),
        F.sum(F.col("cell.n") * F.col("good")).alias("good"),
        F.sum(F.col("cell.n") * F.col("toxic")).alias("toxic"),
    )
    return counts.filter("docs > 0")


def _selectors() -> dict[str, np.ndarray]:
    """For each quantity, the choice (pass, fail or all) along each axis at every step of every order."""
    found = {name: np.zeros((len(ORDERS) * len(FILTERS), len(FILTERS), 2), np.int64) for name in ("kept", "removed", "failing", "alone")}
    row = 0
    for order in ORDERS:
        for step, letter in enumerate(order):
            here = FILTERS.index(letter)
            before = {FILTERS.index(x) for x in order[:step]}
            for axis in range(len(FILTERS)):
                gone_through = _PASS if axis in before else _ALL
                found["kept"][row, axis] = _PASS if axis == here else gone_through
                found["removed"][row, axis] = _FAIL if axis == here else gone_through
                found["failing"][row, axis] = _FAIL if axis == here else _ALL
                found["alone"][row, axis] = _FAIL if axis == here else _PASS
            row += 1
    return found


def contract(tensors: np.ndarray, select: np.ndarray) -> np.ndarray:
    """What each row of ``select`` chooses of each of the tensors (tensor, A, B, C, D, E)."""
    axes = [select[:, k] for k in range(len(FILTERS))]
    return np.einsum("tabcde,na,nb,nc,nd,ne->tn", tensors, *axes, optimize=True)


def step_counts(tensors: np.ndarray) -> dict[str, np.ndarray]:
    """The counts at every step of every order, from the tensors of all, good and toxic documents."""
    chosen = {name: contract(tensors, select) for name, select in _selectors().items()}
    kept, removed = chosen["kept"][0], chosen["removed"]
    letters = np.array([FILTERS.index(x) for order in ORDERS for x in order])
    shapley = np.array([removed[0][letters == k].sum() for k in range(len(FILTERS))], np.int64)
    return {
        "kept": kept,
        "removed": removed[0],
        "redundant": chosen["failing"][0] - removed[0],
        "unique_fails": chosen["alone"][0],
        "good_lost": removed[1],
        "toxic_lost": removed[2],
        "shapley": shapley[letters],
    }


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, filter_order and step (1 to 5): kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``part`` is the source, the empty string for a null one. Null texts are empty; an empty text fails A alone, and copies of
    it E. Rows without a doc_id never fail E, nor do repeated rows of the smallest id of a text. Of several labels of one
    document any counts; labels without a document change nothing. An empty table has no part and gives no rows. Columns
    besides doc_id, text and source are not read.
    """
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def audit(table: pa.Table) -> pa.Table:
        tensors = np.zeros((3, 2, 2, 2, 2, 2), np.int64)
        bits = table["bits"].to_numpy()
        places = tuple((bits >> k) & 1 for k in range(len(FILTERS)))
        for k, name in enumerate(("docs", "good", "toxic")):
            tensors[(k, *places)] = table[name].to_numpy()
        counts = step_counts(tensors)
        n = len(ORDERS) * len(FILTERS)
        part = pa.array([table["part"][0].as_py()] * n, pa.string())
        orders = pa.array(np.repeat(np.array(ORDERS, object), len(FILTERS)), pa.string())
        steps = pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS)))
        return pa.table([part, orders, steps, *(pa.array(counts[c]) for c in names)], ["part", "filter_order", "step", *names])

    longs = ", ".join(f"{c} long" for c in names)
    cells = contingency(docs, labels)
    return cells.groupBy("part").applyInArrow(audit, f"part string, filter_order string, step int, {longs}")
