"""Removal of repeated 50-byte strings by suffix sorting.

Every window of LENGTH bytes is a suffix cut to that length. Windows are dealt out by an anchor, the smallest k-mer hash in
them, so that equal windows meet in one bucket and neighbouring windows travel as one stretch of text. Within a bucket the
windows are sorted deep-shallow: multikey quicksort on letters of eight bytes to a shallow depth, then a blind trie orders
each group that still shares its prefix. Windows that are equal in full lie side by side; of those, all in documents with
other than the smallest id are removed.

Before anything is shuffled, a task combines its own windows: only the first of equal ones travels, so a passage that very
many documents share reaches its bucket once per piece of input. Anchors that are frequent throughout are split by the
text next to them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formtide.llm.bitmap import marked, may_hold
from formtide.llm.tokens import buffers, mix, slices
from formtide.session import materialize

LENGTH = 50
#: Bytes of a k-mer; any window has LENGTH - KMER + 1 of them.
KMER = 14
#: Input bytes of one bucket, about.
BUCKET = 4_000_000
#: Bytes that a task combines at a time.
PIECE = 1 << 19
#: Pieces whose stretches are packed together.
HELD = 4
#: Depth of the multikey quicksort, in letters of eight bytes; blind tries order what lies deeper.
SHALLOW = 3
#: Anchors of more than this share of all stretches are frequent; there are fewer than its inverse.
FREQUENT = 2e-5
#: Bits, as a power of two, of the bitmap of texts with repeats: 4 MB whatever the input.
BITMAP = 25
#: Bytes beside a frequent anchor that also decide on the bucket.
BESIDE = (LENGTH - KMER) // 2

_SPAN = LENGTH - KMER + 1
_MIXER = np.random.default_rng(77).integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)


def _letters(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, the first byte as its highest; zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(LENGTH + 16, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + LENGTH + 8,), (1,))
    return words.byteswap()


def _window_hashes(letters: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the LENGTH bytes from each of the first n positions."""
    places = [*range(0, LENGTH - 7, 8), LENGTH - 8]
    total = np.zeros(n, np.uint64)
    for k, j in enumerate(places):
        total += (letters[j : j + n] ^ (letters[j : j + n] >> np.uint64(29))) * _MIXER[k]
    return mix(total)


def _kmer_hashes(letters: np.ndarray, n: int) -> np.ndarray:
    return mix(letters[:n] * _MIXER[6] ^ (letters[KMER - 8 : KMER - 8 + n] * _MIXER[7] >> np.uint64(7)))


def _equal_windows(letters: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    same = np.ones(len(a), bool)
    for j in [*range(0, LENGTH - 7, 8), LENGTH - 8]:
        same &= letters[a + j] == letters[b + j]
    return same


class Piece:
    """The windows of some texts: their anchors, and where they are."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, n = data, offsets, len(data)
        self.letters = letters = _letters(data)
        self.n = max(0, n - LENGTH + 1)
        self.text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        self.valid = self.text[: self.n] == self.text[LENGTH - 1 : LENGTH - 1 + self.n]
        self.hash = _kmer_hashes(letters, n)
        mask = (np.uint64(1) << np.uint64(max(1, n.bit_length()))) - np.uint64(1)
        low = (self.hash & ~mask) | np.arange(n, dtype=np.uint64)
        size = 1
        while size * 2 <= _SPAN:
            low, size = np.minimum(low[:-size], low[size:]), size * 2
        if size < _SPAN and len(low) > _SPAN - size:
            low = np.minimum(low[: len(low) - (_SPAN - size)], low[_SPAN - size :])
        self.anchor = (low[: self.n] & mask).astype(np.int64)

    def runs(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) window of stretches of kept windows with one text and one anchor."""
        if not keep.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = np.ones(self.n, bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (keep[1:] != keep[:-1]) | (self.text[1 : self.n] != self.text[: self.n - 1])
        return np.flatnonzero(new & keep), np.flatnonzero(np.append(new[1:], True) & keep)

    def first_and_repeated(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(windows that are the first of their kind, windows that a text with a smaller id has too).

        Texts are in order of ``ids``. Repetitions within one text, or among texts of one id, are neither.
        """
        first, repeated = self.valid.copy(), np.zeros(self.n, bool)
        a, b = self.runs(self.valid)
        shared = _recurring(self.hash[self.anchor[a]])  # equal windows have equal anchors
        a, sizes = a[shared], (b - a + 1)[shared]
        if not len(a):
            return first, repeated
        where = np.arange(sizes.sum()) + np.repeat(a - (np.cumsum(sizes) - sizes), sizes)
        hashes = _window_hashes(self.letters, self.n)[where]
        order = np.argsort(hashes)
        hashes, where = hashes[order], where[order]
        new = np.ones(len(where), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(where)))
        more = np.repeat(sizes > 1, sizes)  # windows whose hash another one has
        head = np.repeat(np.minimum.reduceat(where, starts), sizes)[more]
        where = where[more]
        same = _equal_windows(self.letters, where, head)  # a hash that two kinds share keeps them all
        own, theirs = self.text[where], self.text[head]
        # Only the first of a text travels; rows of one id each keep their own first.
        first[where[same & (where != head) & ((own == theirs) | (ids[own] != ids[theirs]))]] = False
        repeated[where[same & (ids[own] > ids[theirs])]] = True
        return first, repeated


def _recurring(hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes occur more than once."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    twin = np.zeros(len(hashes), bool)
    twin[1:] = ordered[1:] == ordered[:-1]
    twin[:-1] |= twin[1:].copy()
    out = np.zeros(len(hashes), bool)
    out[order] = twin
    return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Piece, np.ndarray, np.ndarray]]:
    for batch in slices(batches, "text", PIECE):
        batch = batch.sort_by("doc_id")
        piece = Piece(*buffers(batch.column("text")))
        if piece.n > 0 and piece.valid.any():
            yield piece, batch.column("doc_id").to_numpy(), batch.column("key").to_numpy()


def _pack(array: np.ndarray) -> bytes:
    """Numbers with like bytes side by side, compressed."""
    width = array.dtype.itemsize
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).view(np.uint8).reshape(-1, width).T.tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


_STRETCHES = "bucket int, repeated boolean, ids binary, keys binary, starts binary, counts binary, bytes binary"


def _dealt(piece: Piece, windows: np.ndarray, hot: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, bucket) of stretches of ``windows``. The bucket follows from the anchor; stretches of a frequent anchor
    are parted into windows with enough text before it and the others, and the text on that side decides, too."""
    a, b = piece.runs(windows)
    anchor = piece.anchor[a]
    place = mix(piece.hash[anchor])
    often = np.zeros(len(a), bool)
    if len(hot) and len(a):
        at = np.minimum(np.searchsorted(hot, piece.hash[anchor]), len(hot) - 1)
        often = hot[at] == piece.hash[anchor]
    parts = [(a[~often], b[~often], place[~often])]
    a, b, anchor = a[often], b[often], anchor[often]
    turn = anchor - BESIDE  # the last window that begins early enough
    for side, first, last, at in ((1, a, np.minimum(b, turn), turn), (2, np.maximum(a, turn + 1), b, anchor)):
        some = first <= last
        certificate = np.full(some.sum(), np.uint64(side), np.uint64)
        for k, j in enumerate([*range(0, KMER + BESIDE - 7, 8), KMER + BESIDE - 8]):
            certificate += piece.letters[at[some] + j] * _MIXER[k]
        parts.append((first[some], last[some], mix(certificate)))
    a, b, place = (np.concatenate([x[k] for x in parts]) for k in range(3))
    return a, b, (((place >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _stretches(rows: DataFrame, buckets: int, frequent: np.ndarray) -> DataFrame:
    """Stretches of text by bucket, and (repeated) the stretches of windows that were settled within a piece."""
    known = rows.sparkSession.sparkContext.broadcast(frequent.tobytes())
    kinds = (pa.int32(), pa.bool_(), *[pa.binary()] * 5)
    names = ("bucket", "repeated", "ids", "keys", "starts", "counts", "bytes")

    def packed(held: list[tuple]) -> pa.RecordBatch:
        """One row per bucket from (repeated, buckets, ids, keys, starts, counts, bytes) of some pieces."""
        press, out = zstandard.ZstdCompressor(level=3), []
        for settled in (False, True):
            some = [x[1:] for x in held if x[0] == settled]
            if not some:
                continue
            bucket, ids, keys, starts, counts = (np.concatenate([x[k] for x in some]) for k in range(5))
            data = np.concatenate([x[5] for x in some])
            sizes = counts + LENGTH - 1
            begins = np.cumsum(sizes) - sizes
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0))
            for k, at in enumerate(np.split(order, edges[1:])):
                text = b""
                if not settled:
                    ends = np.cumsum(sizes[at])
                    text = press.compress(data[np.arange(ends[-1]) + np.repeat(begins[at] - (ends - sizes[at]), sizes[at])].tobytes())
                cells = (ids[at], keys[at] ^ ids[at], starts[at], counts[at])
                out.append((int(bucket[order[edges[k]]]), settled, *map(_pack, cells), text))
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)], list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = np.frombuffer(known.value, np.uint64)
        held: list[tuple] = []
        for count, (piece, ids, keys) in enumerate(_pieces(batches), 1):
            first, repeated = piece.first_and_repeated(ids)
            a, b, bucket = _dealt(piece, first, hot, buckets)
            sizes = b - a + LENGTH
            data = piece.data[np.arange(sizes.sum()) + np.repeat(a - (np.cumsum(sizes) - sizes), sizes)]
            text = piece.text[a]
            held.append((False, bucket, ids[text], keys[text], a - piece.offsets[text], b - a + 1, data))
            if repeated.any():
                piece.anchor = np.zeros(piece.n, np.int64)  # settled stretches go on across anchors
                a, b = piece.runs(repeated)
                text = piece.text[a]
                bucket = np.full(len(a), mix(keys[:1].view(np.uint64))[0] % np.uint64(buckets), np.int64)
                held.append((True, bucket, ids[text], keys[text], a - piece.offsets[text], b - a + 1, np.zeros(0, np.uint8)))
            del piece, data, first, repeated
            if count % HELD == 0:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    return rows.mapInArrow(run, _STRETCHES)


def _frequent_anchors(rows: DataFrame) -> np.ndarray:
    """Hashes of anchors with more than FREQUENT of all stretches, fewer than 1 / FREQUENT of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, _, _ in _pieces(batches):
            a, _ = piece.runs(piece.valid)
            found, times = np.unique(piece.hash[piece.anchor[a]], return_counts=True)
            more = times > 1  # what is frequent throughout recurs in pieces of this size
            found, times = np.append(found[more].view(np.int64), 0), np.append(times[more], len(a))
            total = np.append(np.zeros(more.sum(), bool), True)
            yield pa.RecordBatch.from_arrays([pa.array(total), pa.array(found), pa.array(times.astype(np.int64))], ["total", "anchor", "times"])

    counts = rows.mapInArrow(run, "total boolean, anchor long, times long").groupBy("total", "anchor").agg(F.sum("times").alias("times"))
    counts = materialize(counts, "anchors")
    total = counts.filter("total").agg(F.sum("times")).first()[0] or 0
    hot = counts.filter(~F.col("total") & (F.col("times") > FREQUENT * total) & (F.col("times") > 64)).select("anchor").toArrow()
    return np.sort(hot["anchor"].to_numpy().view(np.uint64))


def blind_trie(data: bytes, positions: list[int], depth: int, end: int) -> list[list[int]]:
    """``positions`` in the order of ``data[p + depth : p + end]``, equal ones in one list.

    A blind trie: inner nodes hold the place of the byte in which their branches differ and skip what lies between. A
    position goes down blindly to some leaf, is compared with it once, and branches off where they first differ.
    """
    root: list = [None, [positions[0]]]  # leaf: [None, positions]; inner node: [place, {byte: node}]
    for p in positions[1:]:
        node, path = root, []
        while node[0] is not None:
            path.append(node)
            branches = node[1]
            node = branches.get(data[p + node[0]]) or next(iter(branches.values()))
        q = node[1][0]
        ours, theirs = data[p + depth : p + end], data[q + depth : q + end]
        if ours == theirs:
            node[1].append(p)
            continue
        differ = depth
        for x, y in zip(ours, theirs, strict=True):
            if x != y:
                break
            differ += 1
        node = root
        for inner in path:  # the node at which the place of difference belongs
            if inner[0] >= differ:
                node = inner
                break
            node = inner[1].get(data[p + inner[0]])
            if node is None:
                node = inner
                break
        if node[0] == differ:
            node[1][data[p + differ]] = [None, [p]]
        else:
            old = [node[0], node[1]]
            node[0], node[1] = differ, {data[q + differ]: old, data[p + differ]: [None, [p]]}
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node[0] is None:
            out.append(node[1])
        else:
            stack += [node[1][c] for c in sorted(node[1], reverse=True)]
    return out


def equal_windows(data: np.ndarray, positions: np.ndarray) -> Iterator[list[int]]:
    """Lists of ``positions`` whose LENGTH bytes are equal, of two or more, in the order of those bytes."""
    letters = _letters(data)
    group = np.zeros(len(positions), np.int64)
    for depth in range(SHALLOW):
        order = np.lexsort((letters[positions + 8 * depth], group)) if depth else np.argsort(letters[positions], kind="quicksort")
        positions, group = positions[order], group[order]
        key = letters[positions + 8 * depth]
        new = np.ones(len(positions), bool)
        new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        group = np.cumsum(new)
        alone = new & np.append(new[1:], True)  # in place for good
        positions, group = positions[~alone], group[~alone]
    raw = data.tobytes()
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    listed, ends = positions.tolist(), [*starts[1:].tolist(), len(positions)]
    for a, b in zip(starts.tolist(), ends, strict=True):
        yield from (x for x in blind_trie(raw, listed[a:b], 8 * SHALLOW, LENGTH) if len(x) > 1)


def _first_anchors(data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hash of the anchor of each stretch of ``data``, the smallest in its first window."""
    sizes = counts + LENGTH - 1
    ends = np.cumsum(sizes)
    out = [np.zeros(0, np.uint64)]
    for k in range(0, len(counts), 4096):
        begin, end = ends[k] - sizes[k], ends[min(k + 4096, len(counts)) - 1]
        hashes = _kmer_hashes(_letters(data[begin:end]), end - begin)
        at = (ends[k : k + 4096] - sizes[k : k + 4096] - begin)[:, None] + np.arange(_SPAN)
        out.append(hashes[at].min(axis=1))
    return np.concatenate(out)


def _repeats(table: pa.Table) -> pa.Table:
    """(key, start, count) of windows of one bucket that a document with a smaller id has too."""
    out = []
    ids, keys, starts, counts, parts = [], [], [], [], []
    for row in table.to_pylist():
        own = _unpack(row["ids"], np.int64)
        cells = own, _unpack(row["keys"], np.int64) ^ own, _unpack(row["starts"], np.int64), _unpack(row["counts"], np.int64)
        if row["repeated"]:
            out.append(cells[1:])
            continue
        for to, cell in zip((ids, keys, starts, counts), cells, strict=True):
            to.append(cell)
        parts.append(zstandard.ZstdDecompressor().decompress(row["bytes"]))
    if ids:
        ids, keys, starts, counts = (np.concatenate(x) for x in (ids, keys, starts, counts))
        data = np.frombuffer(b"".join(parts), np.uint8)
        del parts
        shared = _recurring(_first_anchors(data, counts))  # the others have no equal
        ids, keys, starts = ids[shared], keys[shared], starts[shared]
        data, counts = data[np.repeat(shared, counts + LENGTH - 1)], counts[shared]
        sizes = counts + LENGTH - 1
        at = np.cumsum(sizes) - sizes
        # Equal stretches count once, for the smallest id; the others are settled as a whole.
        text = data.tobytes()
        kinds: dict[bytes, int] = {}
        kind = np.array([kinds.setdefault(text[a : a + n], len(kinds)) for a, n in zip(at.tolist(), sizes.tolist(), strict=True)])
        del text, kinds
        order = np.lexsort((ids, kind))
        head = np.ones(len(order), bool)
        head[1:] = kind[order][1:] != kind[order][:-1]
        leader = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
        settled = ids[order] > ids[leader]
        out.append((keys[order[settled]], starts[order[settled]], counts[order[settled]]))
        left = np.sort(order[~settled])
        windows = np.arange(counts[left].sum()) - np.repeat(np.cumsum(counts[left]) - counts[left], counts[left])
        owner = np.repeat(left, counts[left])
        positions = at[owner] + windows
        owners = np.zeros(len(data), np.int32)
        owners[positions] = owner
        marked: list[int] = []
        smallest = ids.tolist()
        for same in equal_windows(data, positions):
            of = owners[same].tolist()
            least = min(smallest[k] for k in of)
            marked += [p for p, k in zip(same, of, strict=True) if smallest[k] > least]
        marks = np.sort(np.array(marked, np.int64))
        if len(marks):
            new = np.ones(len(marks), bool)
            new[1:] = (np.diff(marks) != 1) | (owners[marks[1:]] != owners[marks[:-1]])
            a = marks[new]
            n = np.diff(np.append(np.flatnonzero(new), len(marks)))
            who = owners[a]
            out.append((keys[who], starts[who] + a - at[who], n))
    columns = [np.concatenate([x[k] for x in out]).astype(np.int64) if out else np.zeros(0, np.int64) for k in range(3)]
    return pa.table([pa.array(c) for c in columns], ["key", "start", "count"])


def repeated_windows(rows: DataFrame) -> DataFrame:
    """(key, start, count): windows of ``rows`` (doc_id, key, text) that start in a text of a smaller doc_id too.

    Of equal windows within one text, only one may be listed.
    """
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    stretches = _stretches(rows, int(max(1, size // BUCKET)), _frequent_anchors(rows))
    return stretches.groupBy("bucket").applyInArrow(lambda table: _repeats(table.drop_columns(["bucket"])), "key long, start long, count long")


def _cut(text: bytes, marks: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, spans removed) if the marked windows and all that equal them go."""
    data = np.frombuffer(text, np.uint8)
    n = len(data) - LENGTH + 1
    starts = np.concatenate([np.arange(a, a + c) for a, c in marks])
    hashes = _window_hashes(_letters(data), n)
    hit = np.isin(hashes, hashes[starts]).astype(np.int32)
    edges = np.zeros(len(data) + 1, np.int32)
    edges[:n] += hit
    edges[LENGTH : LENGTH + n] -= hit
    gone = np.cumsum(edges[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return data[~gone].tobytes(), int(gone.sum()), spans


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, kept (binary), n_bytes, n_removed, n_spans.

    Removed is each byte that a LENGTH-byte string covers which also starts in a text with a smaller doc_id. Null texts are
    empty. Rows of one doc_id don't remove from each other; a null doc_id is not smaller or larger than any, so such rows
    stay whole. Equal windows within one text are recognised by 64-bit hashes; windows of different texts are compared.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    ids = rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("doc_id IS NOT NULL AND n > 1")
    # Rows that share an id are told apart by their text, too.
    key = F.col("doc_id") if ids.isEmpty() else F.xxhash64("doc_id", "text")
    rows = rows.withColumn("key", F.when(F.col("doc_id").isNotNull(), key))
    found = repeated_windows(rows.filter("doc_id IS NOT NULL"))
    found = materialize(found.withColumn("hash", F.xxhash64("key")), "repeats")
    marks = found.groupBy("key").agg(F.collect_list(F.struct("start", "count")).alias("marks"))
    # Texts without any repeat are not shuffled, but for the few that the bitmap takes for others.
    bitmap = docs.sparkSession.sparkContext.broadcast(marked(found, "hash", BITMAP))

    def touched(batches: Iterator[pa.RecordBatch], hit: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("hash").to_numpy().view(np.uint64)
            some = may_hold(bitmap.value, keys, BITMAP) & batch.column("key").is_valid().to_numpy(zero_copy_only=False)
            yield batch.drop_columns(["hash"]).filter(pa.array(some == hit))

    hashed = rows.withColumn("hash", F.xxhash64("key"))
    some, rest = (hashed.mapInArrow(lambda b, hit=hit: touched(b, hit), rows.schema) for hit in (True, False))
    joined = some.join(marks, "key", "left").select("doc_id", "text", "marks")
    joined = joined.unionByName(rest.select("doc_id", "text", F.lit(None).cast(joined.schema["marks"].dataType).alias("marks")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                cells = []
                for text, marks in zip(part.column("text"), part.column("marks"), strict=True):
                    text = text.as_py().encode()
                    rest = _cut(text, [(m["start"], m["count"]) for m in marks.as_py()]) if marks.is_valid else (text, 0, 0)
                    cells.append((rest[0], len(text), *rest[1:]))
                kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
                arrays = [pa.array([c[k] for c in cells], t) for k, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return joined.mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
