"""Katz backoff language model of a corpus, and the log10 probability of every text under it.

The training documents give unigram and bigram counts. Counts up to GOOD_TURING are discounted by Good and Turing's
estimate; what the bigrams of a context give up goes to the words not seen after it, in proportion to their unigram
probability, by a backoff weight that makes each context sum to one. Words never seen share what the unigrams give up. A
token is evaluated as its bigram, where that was seen, else by its context's weight and its unigram.

All of it is tables. ``vocabulary`` has a number for each training word, the most frequent first. So the count of a word
follows from its number and a list of the distinct counts; N tokens have at most sqrt(2 N) of those, and only that list is
broadcast. Texts travel as packed pieces of numbers, bigrams as packed lists by buckets of their context; a context that
is too frequent for one bucket is split by the word that follows. ``bigrams`` holds the counts, ``contexts`` the totals and
weights.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formtide.llm.common import text_of
from formtide.llm.tokens import buffers, mix, slices
from formtide.session import materialize

#: Largest count that is discounted.
GOOD_TURING = 5
#: Tokens of a piece, about, and of a bucket of bigrams, about.
PIECE = 1_000_000
BUCKET = 3_000_000
#: Words of the pieces in one bucket of the vocabulary, about.
WORDS = 800_000
#: Pieces in one partition.
TOGETHER = 4
#: Bytes of text that are split into words at a time.
SEGMENT = 1 << 20
#: Numbers that are no words: before the first token, after the last, and words that no training document has.
BEGIN, END, UNKNOWN = 0, 1, 2
FIRST = 3

_LOWER = bytes(b + 32 if ord("A") <= b <= ord("Z") else b for b in range(256))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pack(array: np.ndarray) -> bytes:
    """Numbers with like bytes side by side, compressed."""
    planes = np.ascontiguousarray(array, np.uint32).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view(np.uint32).ravel()


class _Piece:
    """Tokens of some texts, or of a part of one, as numbers of the piece's own."""

    def __init__(self):
        self.kinds: dict[bytes, int] = defaultdict(count(2).__next__)
        self.parts: list[tuple] = []
        self.codes: list[np.ndarray] = []
        self.size = 0

    def open(self, row: tuple, context: bytes | None) -> None:
        """A part begins, after ``context`` if its text began in another piece."""
        self.codes.append(np.array([BEGIN if context is None else self.kinds[context]], np.uint32))
        self.parts.append([*row, 0])

    def add(self, words: list[bytes]) -> None:
        self._append(np.fromiter(map(self.kinds.__getitem__, words), np.uint32, len(words)))

    def end(self) -> None:
        self._append(np.array([END], np.uint32))

    def _append(self, codes: np.ndarray) -> None:
        self.codes.append(codes)
        self.parts[-1][-1] += len(codes)
        self.size += len(codes)

    def packed(self) -> tuple:
        """(doc_id, row, held_out, sizes, tokens, words, counts), numbered by frequency; counts are those of training."""
        codes = np.concatenate(self.codes)
        sizes = np.array([p[-1] for p in self.parts], np.int64)
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        learnt = np.repeat(~np.array([p[2] for p in self.parts], bool), sizes + 1)
        learnt[starts] = False  # contexts are counted where they are tokens
        n = len(self.kinds) + 2
        often = np.bincount(codes, minlength=n)
        often[:2] = len(codes) + 1
        order = np.argsort(-often, kind="stable")
        number = np.empty(n, np.uint32)
        number[order] = np.arange(n, dtype=np.uint32)
        words = list(self.kinds)
        words = b"\n".join(words[k - 2] for k in order[2:].tolist())
        counts = np.bincount(number[codes[learnt]], minlength=n)
        columns = [[p[k] for p in self.parts] for k in range(3)]
        return *columns, sizes.tolist(), pack(number[codes]), zstandard.ZstdCompressor(level=3).compress(words), pack(counts)


def pieces(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, row, held_out, text) as packed pieces, each with its own numbers and words."""
    kind = docs.schema["doc_id"].dataType
    names = ["piece", "doc_id", "row", "held_out", "sizes", "tokens", "words", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, made = _Piece(), count(TaskContext.get().partitionId() << 32)

        def flushed() -> pa.RecordBatch:
            cells = piece.packed()
            ids = pa.array([cells[0]], pa.list_(id_type))
            types = (pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), *[pa.binary()] * 3)
            return pa.RecordBatch.from_arrays([pa.array([next(made)]), ids, *(pa.array([c], t) for c, t in zip(cells[1:], types, strict=True))], names)

        id_type = None
        for batch in slices(batches, "text"):
            id_type = batch.schema.field("doc_id").type
            data, offsets = buffers(batch.column("text"))
            offsets = offsets.tolist()
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "held_out")), strict=True)
            for row, at, stop in zip(rows, offsets[:-1], offsets[1:], strict=True):
                piece.open(row, None)
                while at < stop:
                    text = data[at : min(stop, at + SEGMENT)].tobytes()
                    if at + len(text) < stop:  # to the end of the word
                        gap = _SPACE.search(data[at + len(text) : stop].tobytes())
                        text = data[at : at + len(text) + gap.start()].tobytes() if gap else data[at:stop].tobytes()
                    at += len(text)
                    words = text.translate(_LOWER).split()
                    piece.add(words)
                    if piece.size >= PIECE and at < stop and words:
                        yield flushed()
                        piece = _Piece()
                        piece.open(row, words[-1])
                piece.end()
                if piece.size >= PIECE:
                    yield flushed()
                    piece = _Piece()
        if piece.size:
            yield flushed()

    kind = kind.simpleString()
    schema = f"piece long, doc_id array<{kind}>, row array<long>, held_out array<boolean>, sizes array<long>, tokens binary, words binary, counts binary"
    return docs.select("doc_id", "row", "held_out", "text").mapInArrow(run, schema)


def _words(cell: bytes) -> list[bytes]:
    joined = zstandard.ZstdDecompressor().decompress(cell)
    return joined.split(b"\n") if joined else []


def _word_array(cells: pa.ChunkedArray) -> tuple[pa.Array, list[int]]:
    """(the words of all cells one after the other, how many each cell has). No cell is empty."""
    joined = [zstandard.ZstdDecompressor().decompress(c.as_py()) for c in cells]
    whole = pa.array([b"\n".join(joined)] if joined else [], pa.large_binary())
    words = pc.split_pattern(whole, pattern=b"\n").flatten().cast(pa.binary())
    return words, [x.count(b"\n") + 1 for x in joined]


def _dealt(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of the words in order, where each bucket's words are)."""
    bucket = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(buckets)
    order = np.argsort(bucket, kind="stable")
    return bucket, order


def _asked(made: DataFrame, buckets: int) -> DataFrame:
    """(bucket, piece, words, counts): the words of each piece by bucket of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for piece, cell, counts in zip(batch.column("piece").to_pylist(), batch.column("words"), batch.column("counts"), strict=True):
                words, counts = _words(cell.as_py()), unpack(counts.as_py())[2:]
                bucket, order = _dealt(words, buckets)
                cut = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)) if len(order) else np.zeros(0, np.int64)
                parts = np.split(order, cut[1:]) if len(order) else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(bucket[p[0]]) for p in parts], pa.int64()),
                        pa.array([piece] * len(parts), pa.int64()),
                        pa.array([press.compress(b"\n".join(words[k] for k in p.tolist())) for p in parts], pa.binary()),
                        pa.array([pack(counts[p]) for p in parts], pa.binary()),
                    ],
                    ["bucket", "piece", "words", "counts"],
                )

    return made.select("piece", "words", "counts").mapInArrow(run, "bucket long, piece long, words binary, counts binary")


def vocabulary(made: DataFrame, buckets: int) -> DataFrame:
    """(id, word, n) of the words of training documents, numbered from FIRST on, the most frequent first."""

    def combine(table: pa.Table) -> pa.Table:
        words, _ = _word_array(table["words"])
        counts = np.concatenate([unpack(c) for c in table["counts"].to_pylist()]).astype(np.int64)
        found = pa.table({"word": words, "n": pa.array(counts)}).group_by("word").aggregate([("n", "sum")])
        found = found.select(["word", "n_sum"]).rename_columns(["word", "n"])
        return found.filter(pc.greater(found["n"], 0))

    words = _asked(made, buckets).groupBy("bucket").applyInArrow(combine, "word binary, n long")
    at = F.monotonically_increasing_id()
    ordered = words.orderBy(F.desc("n"), "word").select("word", "n", F.shiftright(at, 33).alias("part"), at.bitwiseAND((1 << 33) - 1).alias("place"))
    ordered = materialize(ordered, "words")
    # Where each part of the sort begins: one row a partition.
    sizes = sorted(ordered.groupBy("part").agg(F.count("*").alias("size")).toArrow().to_pylist(), key=lambda x: x["part"])
    start, starts = FIRST, []
    for row in sizes:
        starts.append((row["part"], start))
        start += row["size"]
    if start >= 1 << 32:
        raise ValueError("more than 2**32 different words")
    starts = F.broadcast(made.sparkSession.createDataFrame(starts, "part long, start long"))
    return ordered.join(starts, "part").select((F.col("start") + F.col("place")).alias("id"), "word", "n")


def discounts(times: dict[int, int]) -> np.ndarray:
    """d[r] by which a count of r is multiplied, r up to GOOD_TURING, from how many kinds have each count.

    Where the estimate is not between 0 and 1, as with few or odd counts, it is r / (r + 1).
    """
    n, k = (lambda r: times.get(r, 0)), GOOD_TURING
    d = np.ones(k + 1)
    common = (k + 1) * n(k + 1) / n(1) if n(1) else 1.0
    for r in range(1, k + 1):
        value = ((r + 1) * n(r + 1) / (r * n(r)) - common) / (1 - common) if n(r) and common != 1 else 0.0
        d[r] = value if 0 < value < 1 else r / (r + 1)
    return d


class Unigrams:
    """Counts and probabilities of numbered words, from the list of distinct counts."""

    def __init__(self, counts: np.ndarray, times: np.ndarray, texts: int):
        """``times`` words have each of ``counts``; ``texts`` training documents have an end."""
        order = np.argsort(-counts)
        self.counts = np.append(counts[order], 0).astype(np.int64)
        self.first = FIRST + np.append(0, np.cumsum(times[order])).astype(np.int64)
        self.texts = texts
        kinds = dict(zip(counts.tolist(), times.tolist(), strict=True))
        if texts:
            kinds[texts] = kinds.get(texts, 0) + 1
        self.tokens = sum(c * t for c, t in kinds.items())
        self.kinds = sum(kinds.values())
        self.discount = discounts(kinds)
        left = sum(c * t * (1 - self.discount[c]) for c, t in kinds.items() if c <= GOOD_TURING)
        # With no count to discount, one more token is set aside for words never seen.
        self.total = self.tokens + (1 if left <= 0 else 0)
        self.unknown = (left if left > 0 else 1) / self.total

    def count(self, ids: np.ndarray) -> np.ndarray:
        """How often training documents have each token."""
        ids = ids.astype(np.int64)
        found = self.counts[np.maximum(np.searchsorted(self.first, ids, side="right") - 1, 0)]
        return np.where(ids >= FIRST, found, np.where(ids == END, self.texts, 0))

    def follows(self, ids: np.ndarray) -> np.ndarray:
        """How often training documents have each context: every token but the end is followed by one."""
        return np.where(ids == BEGIN, self.texts, np.where(ids == END, 0, self.count(ids)))

    def probability(self, ids: np.ndarray) -> np.ndarray:
        counts = self.count(ids)
        kept = counts * np.append(self.discount, 1.0)[np.minimum(counts, GOOD_TURING + 1)]
        return np.where(counts > 0, kept / self.total, self.unknown)


def unigrams(words: DataFrame, texts: int) -> Unigrams:
    """The list of distinct counts reaches the driver: at most sqrt(2 N) rows of N tokens."""
    found = words.groupBy("n").agg(F.count("*").alias("times")).toArrow()
    return Unigrams(found["n"].to_numpy(), found["times"].to_numpy(), texts)


def encoded(made: DataFrame, words: DataFrame, buckets: int, partitions: int) -> DataFrame:
    """(piece, doc_id, row, held_out, sizes, tokens) with the numbers of the vocabulary."""

    def match(table: pa.Table) -> pa.Table:
        known = table.filter(table["piece"].is_null())
        asked = table.filter(table["piece"].is_valid())
        kinds, ids = known["words"].combine_chunks(), np.append(known["id"].to_numpy(), UNKNOWN)
        words, sizes = _word_array(asked["words"])
        found = ids[pc.index_in(words, value_set=kinds).fill_null(len(kinds)).to_numpy()]
        cells = [pack(x) for x in np.split(found, np.cumsum(sizes)[:-1])] if sizes else []
        return pa.table([asked["piece"], asked["bucket"], pa.array(cells, pa.binary())], ["piece", "bucket", "ids"])

    none = F.lit(None)
    asked = _asked(made, buckets).select("bucket", "piece", "words", none.cast("long").alias("id"))
    known = words.select((F.crc32("word") % buckets).alias("bucket"), none.cast("long").alias("piece"), F.col("word").alias("words"), "id")
    found = asked.union(known).groupBy("bucket").applyInArrow(match, "piece long, bucket long, ids binary")
    ids = found.repartition(partitions, "piece").groupBy("piece").agg(F.collect_list(F.struct("bucket", "ids")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                words = _words(batch.column("words")[k].as_py())
                number = np.zeros(len(words) + 2, np.uint32)
                number[:2] = BEGIN, END
                if words:
                    bucket, order = _dealt(words, buckets)
                    for cell in batch.column("ids")[k].as_py():
                        a, b = np.searchsorted(bucket[order], [cell["bucket"], cell["bucket"] + 1])
                        number[order[a:b] + 2] = unpack(cell["ids"])
                tokens = pa.array([pack(number[unpack(batch.column("tokens")[k].as_py())])], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(k, 1) for c in kept), tokens], [*kept, "tokens"])

    kept = ["piece", "doc_id", "row", "held_out", "sizes"]
    joined = made.drop("counts").repartition(partitions, "piece").join(ids, "piece", "left")
    schema = ", ".join(f"{c} {made.schema[c].dataType.simpleString()}" for c in [*kept, "tokens"])
    return joined.mapInArrow(run, schema)


def _bigrams(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context and token as one number, place of the part) of every token."""
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    inside = np.ones(len(tokens), bool)
    inside[starts] = False
    at = np.flatnonzero(inside)
    keys = (tokens[at - 1].astype(np.uint64) << np.uint64(32)) | tokens[at].astype(np.uint64)
    return keys, np.repeat(np.arange(len(sizes)), sizes)


def _lookups(keys: np.ndarray, model: Unigrams, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys with a known context and token, where each of ``keys`` is among them (-1: not), buckets).

    A context with more than half a bucket's tokens is split by the token.
    """
    kinds, at = np.unique(keys, return_inverse=True)
    context, token = kinds >> np.uint64(32), kinds & np.uint64(0xFFFFFFFF)
    times = model.follows(context)
    known = (times > 0) & (model.count(token) > 0)
    place = np.where(known, np.cumsum(known) - 1, -1)
    context, token, times = context[known], token[known], times[known]
    parts = (2 * times // BUCKET + 1).astype(np.uint64)
    bucket = mix(mix(context) + mix(token ^ np.uint64(0x9E3779B9)) % parts) % np.uint64(buckets)
    return kinds[known], place[at], bucket.astype(np.int64)


def _split(bucket: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(buckets, places of each one's entries, in order)."""
    order = np.argsort(bucket, kind="stable")
    if not len(order):
        return bucket, []
    cut = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0))
    return bucket[order[cut]], np.split(order, cut[1:])


def counted(texts: DataFrame, model: Unigrams, buckets: int) -> DataFrame:
    """Rows of bigrams (bucket, contexts, tokens, counts, times of counts), and of answers (bucket, piece, codes).

    The distinct bigrams of each piece meet in buckets with their training counts there. A code is twice the count
    throughout, and one more if the bucket has no bigram of that context with a count that is discounted.
    """
    known = texts.sparkSession.sparkContext.broadcast(model)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                sizes = np.array(batch.column("sizes")[k].as_py(), np.int64)
                keys, part = _bigrams(unpack(batch.column("tokens")[k].as_py()), sizes)
                kinds, at, bucket = _lookups(keys, known.value, buckets)
                learnt = ~np.array(batch.column("held_out")[k].as_py(), bool)[part] & (at >= 0)
                counts = np.bincount(at[learnt], minlength=len(kinds))
                names, places = _split(bucket)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()),
                        pa.array([batch.column("piece")[k].as_py()] * len(places), pa.int64()),
                        pa.array([pack(np.diff(kinds[p] >> np.uint64(32), prepend=np.uint64(0))) for p in places], pa.binary()),
                        pa.array([pack(kinds[p] & np.uint64(0xFFFFFFFF)) for p in places], pa.binary()),
                        pa.array([pack(counts[p]) for p in places], pa.binary()),
                    ],
                    ["bucket", "piece", "contexts", "tokens", "counts"],
                )

    def combine(table: pa.Table) -> pa.Table:
        keys, counts = [], []
        for row in table.select(["contexts", "tokens", "counts"]).to_pylist():
            keys.append((np.cumsum(unpack(row["contexts"]), dtype=np.uint64) << np.uint64(32)) | unpack(row["tokens"]))
            counts.append(unpack(row["counts"]))
        sizes = np.cumsum([len(x) for x in keys])
        kinds, at = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        total = np.bincount(at, np.concatenate(counts), len(kinds)).astype(np.int64)
        seen = total > 0
        kinds_seen, total_seen = kinds[seen], total[seen]
        context = kinds >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, np.diff(context) != 0))
        few = np.add.reduceat((seen & (total <= GOOD_TURING)).astype(np.int64), starts)
        full = np.repeat(few == 0, np.diff(np.append(starts, len(kinds))))
        codes = (2 * total + full)[at]
        times = np.bincount(np.minimum(total_seen, GOOD_TURING + 2), minlength=GOOD_TURING + 3)[: GOOD_TURING + 2]
        n = len(table)
        bucket = pa.array([table["bucket"][0].as_py()] * (n + 1), pa.int64())
        piece = pa.concat_arrays([pa.nulls(1, pa.int64()), *table["piece"].chunks])
        lists = [[pack(np.diff(kinds_seen >> np.uint64(32), prepend=np.uint64(0)))], [pack(kinds_seen & np.uint64(0xFFFFFFFF))], [pack(total_seen)]]
        cells = [pa.array(x + [None] * n, pa.binary()) for x in lists]
        answers = pa.array([None] + [pack(x) for x in np.split(codes, sizes[:-1])], pa.binary())
        return pa.table([bucket, piece, *cells, pa.array([times.tolist()] + [None] * n, pa.list_(pa.int64())), answers], names)

    names = ["bucket", "piece", "contexts", "tokens", "counts", "times", "codes"]
    asked = texts.mapInArrow(ask, "bucket long, piece long, contexts binary, tokens binary, counts binary")
    schema = "bucket long, piece long, contexts binary, tokens binary, counts binary, times array<long>, codes binary"
    return asked.groupBy("bucket").applyInArrow(combine, schema)


def contexts(bigrams: DataFrame, model: Unigrams, discount: np.ndarray) -> DataFrame:
    """(context, total, shift, backoff): log10 of the total taken over the count, and log10 of the backoff weight.

    A context all of whose counts are too large for a discount gets one token more, which is set aside.
    """
    known = bigrams.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = np.append(discount, 1.0)
        for batch in batches:
            for k in range(len(batch)):
                context, token, n = (unpack(batch.column(c)[k].as_py()) for c in ("contexts", "tokens", "counts"))
                if not len(n):
                    continue
                context = np.cumsum(context, dtype=np.uint64).astype(np.int64)
                starts = np.flatnonzero(np.append(True, np.diff(context) != 0))
                left = n * (1 - factor[np.minimum(n, GOOD_TURING + 1)])
                sums = [np.add.reduceat(x, starts) for x in (n.astype(np.int64), left, known.value.probability(token))]
                yield pa.RecordBatch.from_arrays([pa.array(context[starts]), *map(pa.array, sums)], ["context", "total", "left", "seen"])

    sums = bigrams.select("contexts", "tokens", "counts").mapInArrow(run, "context long, total long, left double, seen double")
    sums = sums.groupBy("context").agg(F.sum("total").alias("total"), F.sum("left").alias("left"), F.sum("seen").alias("seen"))
    full = F.col("left") <= 0
    taken = F.col("total") + F.when(full, 1).otherwise(0)
    unseen = F.greatest(1 - F.col("seen"), F.lit(model.unknown))  # a word never seen follows no context
    backoff = F.log10(F.when(full, F.lit(1.0)).otherwise(F.col("left")) / taken / unseen)
    return sums.select("context", "total", (F.log10(taken) - F.log10("total")).alias("shift"), backoff.alias("backoff"))


def _scored(texts: DataFrame, answers: DataFrame, model: Unigrams, discount: np.ndarray, buckets: int) -> DataFrame:
    """Rows of parts (row, doc_id, held_out, n_tokens, n_known, base, score) without what contexts add, and rows (row,
    context, misses, hits) of contexts that add something."""
    known = texts.sparkSession.sparkContext.broadcast(model)
    kind = texts.schema["doc_id"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, factor = known.value, np.append(discount, 1.0)
        for batch in batches:
            for k in range(len(batch)):
                sizes = np.array(batch.column("sizes")[k].as_py(), np.int64)
                keys, part = _bigrams(unpack(batch.column("tokens")[k].as_py()), sizes)
                kinds, at, bucket = _lookups(keys, model, buckets)
                codes = np.zeros(len(kinds) + 1, np.int64)
                given = {cell["bucket"]: cell["codes"] for cell in batch.column("answers")[k].as_py() or ()}
                for name, places in zip(*_split(bucket), strict=True):
                    codes[places] = unpack(given[int(name)])
                codes = codes[at]  # the last entry is for bigrams that surely were not seen
                context, token = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
                seen, full = codes >> 1, (codes & 1).astype(bool)
                times, single = model.follows(context), model.count(token)
                hit = seen > 0
                with np.errstate(divide="ignore", invalid="ignore"):
                    bigram = np.log10(seen * factor[np.minimum(seen, GOOD_TURING + 1)] / times)
                score = np.where(hit, bigram, np.log10(model.probability(token)))
                base = np.log10((single + 1) / (model.tokens + model.kinds + 1))
                n = len(sizes)
                of = lambda x: np.bincount(part, x, n)
                cells = [
                    batch.column("row")[k].values,
                    batch.column("doc_id")[k].values,
                    batch.column("held_out")[k].values,
                    pa.array(sizes),
                    pa.array(of(single > 0).astype(np.int64)),
                    pa.array(of(base)),
                    pa.array(of(score)),
                    *(pa.nulls(n, pa.int64()) for _ in range(3)),
                ]
                yield pa.RecordBatch.from_arrays(cells, names)
                asks = (~hit & (times > 0)) | (hit & full)
                pairs, place = np.unique(np.stack([part[asks], context[asks].astype(np.int64)]), axis=1, return_inverse=True)
                place, m = place.ravel(), pairs.shape[1]
                rows = batch.column("row")[k].values.to_numpy()
                cells = [
                    pa.array(rows[pairs[0]]),
                    *(pa.nulls(m, batch.schema.field(c).type.value_type) for c in ("doc_id", "held_out")),
                    *(pa.nulls(m, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())),
                    pa.array(pairs[1]),
                    *(pa.array(np.bincount(place, x[asks], m).astype(np.int64)) for x in (~hit, hit)),
                ]
                yield pa.RecordBatch.from_arrays(cells, names)

    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "context", "misses", "hits"]
    given = answers.groupBy("piece").agg(F.collect_list(F.struct("bucket", "codes")).alias("answers"))
    joined = texts.join(given, "piece", "left")
    return joined.mapInArrow(
        run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, context long, misses long, hits long"
    )


@dataclass(frozen=True)
class Model:
    """The tables of a model: vocabulary (id, word, n), bigrams (packed by bucket) and contexts (total, shift, backoff)."""

    vocabulary: DataFrame
    bigrams: DataFrame
    contexts: DataFrame
    unigrams: Unigrams
    discount: np.ndarray


def fit_and_score(docs: DataFrame, held_out: str = "held_out") -> tuple[Model, DataFrame]:
    """(model of the rows where ``held_out`` is false, scores of all rows of ``docs`` (doc_id, text, ``held_out``)).

    Scores have doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, one row for each row of ``docs``.
    Null and empty texts have the end as their only token. A null ``held_out`` counts as false. Without training rows every
    token is unknown and has the probability 1. A text of any length is dealt over pieces.
    """
    rows = docs.select("doc_id", F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"), text_of().alias("text"))
    made = materialize(pieces(rows.withColumn("row", F.monotonically_increasing_id())), "pieces")
    tokens = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    total, n_pieces, words = made.agg(F.sum(tokens), F.count("*"), F.sum(F.octet_length("words"))).first()
    texts = rows.filter("NOT held_out").count()
    partitions = max(1, n_pieces // TOGETHER)
    word_buckets, buckets = max(1, (words or 0) // (3 * WORDS)), max(1, (total or 0) // BUCKET)
    known = materialize(vocabulary(made, word_buckets), "vocabulary")
    model = unigrams(known, texts)
    numbers = materialize(encoded(made, known, word_buckets, partitions), "encoded")
    found = materialize(counted(numbers, model, buckets), "bigrams")
    bigrams = found.filter("piece IS NULL").select("bucket", "contexts", "tokens", "counts", "times")
    times = bigrams.select(F.posexplode("times").alias("r", "n")).groupBy("r").agg(F.sum("n").alias("n")).toArrow()
    discount = discounts(dict(zip(times["r"].to_pylist(), times["n"].to_pylist(), strict=True)))
    weights = materialize(contexts(bigrams, model, discount), "contexts")

    answers = found.filter("piece IS NOT NULL").select("piece", "bucket", "codes").repartition(partitions, "piece")
    scored = materialize(_scored(numbers.repartition(partitions, "piece"), answers, model, discount, buckets), "scored")
    added = scored.filter("context IS NOT NULL").select("row", "context", "misses", "hits").join(weights, "context")
    added = added.groupBy("row").agg(F.sum(F.col("misses") * F.col("backoff") - F.col("hits") * F.col("shift")).alias("added"))
    parts = scored.filter("context IS NULL").groupBy("row")
    parts = parts.agg(*(F.first(c).alias(c) for c in ("doc_id", "held_out")), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")))
    scores = parts.join(added, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        (F.col("score") + F.coalesce("added", F.lit(0.0))).alias("score"),
    )
    return Model(known, bigrams, weights, model, discount), scores


def score_documents(docs: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    """Scores of ``docs`` by a model of those whose crc32(doc_id as text) modulo ``folds`` is not ``fold``.

    A null doc_id counts as the empty text. Columns besides doc_id and text are not read; repeated rows stay rows.
    """
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == fold
    return fit_and_score(docs.select("doc_id", "text", held.alias("held_out")))[1]
