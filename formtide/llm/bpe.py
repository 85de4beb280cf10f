"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Merges of a piece of text are chosen by rank. Each rank has a bucket of positions in a linked list of tokens; a bitmap
of two levels marks the ranks whose bucket is not empty, so that find-first-set gives the next rank in two steps
whatever the length of the piece. Entries of pairs that changed meanwhile are recognised and skipped. The work for a
piece of n bytes is O(n) queue operations, which suits very long pieces; short pieces that were seen before come from
a bounded cache.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces that a Python worker keeps; beyond that it starts anew.
CACHE_PIECES = 500_000
#: Longer pieces are not kept.
CACHE_CHARS = 64
#: The bitmap of ranks has words of 2 ** WORD bits and a word above with one bit for each of them.
WORD = 8
MASK = (1 << WORD) - 1


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Token -> rank from lines of base64 and number."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


class Codec:
    """Encodes text to ids and ids to bytes. Every single byte must have a rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.first = [[ranks.get(bytes((a, b)), -1) for b in range(256)] for a in range(256)]
        self.words = [0] * ((max(ranks.values()) >> WORD) + 1)
        self.cache: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the pair of the lowest rank, leftmost first, is merged until none has a rank.

        ``buckets`` holds token starts by the rank of the pair that begins there, ``words`` the low level of the bitmap
        (a bit per rank, all zero between calls), ``top`` a bit per word. ``after`` and ``before`` link the tokens.
        """
        rank_of = self.ranks.get
        if (whole := rank_of(piece)) is not None:
            return [whole]
        n, words, first, top, buckets = len(piece), self.words, self.first, 0, {}
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        after.append(n)
        pair = [first[a][b] for a, b in zip(piece, piece[1:])]
        pair.append(-1)
        for i, rank in enumerate(pair):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    words[rank >> WORD] |= 1 << (rank & MASK)
                    top |= 1 << (rank >> WORD)
        while top:
            w = (top & -top).bit_length() - 1
            bits = words[w]
            rank = (w << WORD) | ((bits & -bits).bit_length() - 1)
            words[w] = bits = bits & (bits - 1)
            if not bits:
                top &= top - 1
            positions = buckets.pop(rank)
            if len(positions) > 1:
                positions.sort()
            for k, i in enumerate(positions):
                if pair[i] != rank:
                    continue  # stale
                j = after[i]
                pair[j] = -1
                after[i] = end = after[j]
                lower = False
                new = -1
                if end < n:
                    before[end] = i
                    new = rank_of(piece[i : after[end]], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            buckets[new] = [i]
                            words[new >> WORD] |= 1 << (new & MASK)
                            top |= 1 << (new >> WORD)
                        lower = new < rank
                pair[i] = new
                h = before[i]
                if h >= 0:
                    pair[h] = new = rank_of(piece[h:end], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(h)
                        else:
                            buckets[new] = [h]
                            words[new >> WORD] |= 1 << (new & MASK)
                            top |= 1 << (new >> WORD)
                        lower = lower or new < rank
                if lower and k + 1 < len(positions):  # the rest waits until the lower rank is done
                    buckets[rank] = positions[k + 1 :]
                    words[w] |= 1 << (rank & MASK)
                    top |= 1 << w
                    break
        ids, ranks, i = [], self.ranks, 0
        while i < n:
            ids.append(ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        cache, extend = self.cache, ids.extend
        for piece in self.split(text):
            known = cache.get(piece)
            if known is None:
                known = tuple(self.merge(piece.encode()))
                if len(piece) <= CACHE_CHARS:
                    if len(cache) >= CACHE_PIECES:
                        cache.clear()
                    cache[piece] = known
            extend(known)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_codecs: dict[tuple[int, str], Codec] = {}


def codec_of(data: bytes, pattern: str) -> Codec:
    """One codec, with its cache, per Python worker and vocabulary."""
    key = (hash(data), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(parse_ranks(data), pattern)
    return _codecs[key]


def encode_texts(docs: DataFrame, vocabulary: bytes, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int); a null text is an empty one. Columns called ``ids`` are replaced.

    ``vocabulary`` is the rank file's content, of fixed size, which is broadcast. Repeated rows stay.
    """
    data = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = docs.drop("ids").withColumn("ids", F.lit(None).cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(data.value, pattern)
        for batch in batches:
            ids = [codec.encode(t or "") for t in batch.column(text).to_pylist()]
            columns = [batch.column(n) for n in batch.schema.names if n != "ids"]
            names = [n for n in batch.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"])

    return docs.mapInArrow(run, schema)


def decode_ids(rows: DataFrame, vocabulary: bytes, pattern: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded`` (binary); null ids give null. An id without a token raises KeyError."""
    data = rows.sparkSession.sparkContext.broadcast(vocabulary)
    schema = rows.drop("decoded").withColumn("decoded", F.lit(None).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(data.value, pattern)
        for batch in batches:
            decoded = [None if x is None else codec.decode(x) for x in batch.column(ids).to_pylist()]
            names = [n for n in batch.schema.names if n != "decoded"]
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(decoded, pa.binary())], [*names, "decoded"])

    return rows.mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary: bytes, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per document: ``keep``, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (bytes of the ids).

    Encodes and decodes in one pass, so that ids do not leave the task. A null text is an empty one; repeated rows
    and null keys stay; an empty table gives an empty result.
    """
    data = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(*keep, docs["text"].cast("string").alias("__text"))
    schema = rows.drop("__text").schema.add("n_tokens", "long").add("ids_sha256", "string")
    schema = schema.add("decoded_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(data.value, pattern)
        spelled = {i: str(i) for i in codec.tokens}
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for value in batch.column("__text"):
                ids = codec.encode(value.as_py() or "")
                counts.append(len(ids))
                encoded.append(hashlib.sha256(",".join(map(spelled.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            columns = [batch.column(n) for n in keep]
            new = [pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *new], [*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, schema)
