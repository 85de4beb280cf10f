"""Benchmark decontamination by spaced seeds.

A seed is a window of words of which a fixed mask ignores some places, so that substituted words there do not hide a copy.
Seeds of benchmark items and of documents are joined by hash; around each hit the two texts are compared word by word on
the same diagonal, and a copy is a stretch in which enough words agree.

The masks depend on the length of the item and lose nothing: however the words that may differ lie in a stretch, one mask
fits between them. Tests count this over all places of substitutions.

Documents only shuffle seeds that may occur in the benchmark: a bitmap of fixed size of all benchmark seeds goes to every
task. It has no misses, and where a benchmark outgrows it, more seeds are shuffled but none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formtide.llm.bitmap import marked, may_hold
from formtide.llm.tokens import LETTERS, buffers, slices, window_hashes, word_hashes

#: Places of a window that count, by mask, for items of SPAN to LONG - 1 words: any four of five.
MASKS = ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4), (1, 2, 3, 4))
SPAN = 5
#: Masks for items of LONG words or more. Items with fewer words than SPAN are seeds as a whole.
LONG_MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 3, 7, 10, 11), (0, 4, 6, 10, 11, 12), (0, 3, 4, 5, 7, 10))
LONG = 15
#: Words of the stretch that is compared (the whole item, if shorter) and the share of them that must agree.
STRETCH = 20
AGREE = 0.8
#: Bits of the bitmap, as a power of two: 4 MB whatever the size of the benchmark.
BITMAP = 25
_WHOLE = tuple(tuple(range(n)) for n in range(1, SPAN))
#: All masks, each with the fewest and most words of the items that have it. Masks of one shape are one.
_SHAPES = tuple(dict.fromkeys(tuple(j - m[0] for j in m) for m in MASKS))
_SEEDS = (
    *((m, len(m), len(m)) for m in _WHOLE),
    *((m, SPAN, LONG - 1) for m in _SHAPES),
    *((m, LONG, None) for m in LONG_MASKS),
)
#: Words before a seed that a stretch around it may begin with. Items that are seeds as a whole begin with it.
_REACH = STRETCH - min(m[-1] + 1 for m in (*_SHAPES, *LONG_MASKS))
_SEED = "seed long, {key}, place int, n_words int, around array<long>"


def _used(benchmark: DataFrame) -> tuple[int, ...]:
    """Numbers of the masks that the items need, by their lengths; at most LONG lengths reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = word_hashes(*buffers(batch.column("text")), LETTERS)[1]
            sizes = np.unique(np.minimum(np.bincount(texts, minlength=len(batch)), LONG))
            yield pa.RecordBatch.from_arrays([pa.array(sizes.astype(np.int32))], ["size"])

    texts = benchmark.select(F.col("text").cast("string").alias("text"))
    sizes = [r["size"] for r in texts.mapInArrow(run, "size int").distinct().collect()]
    return tuple(k for k, (_, least, most) in enumerate(_SEEDS) if any(least <= n <= (most or n) for n in sizes))


def _seeds(rows: DataFrame, key: str, kind: str, used: tuple[int, ...], marks=None) -> DataFrame:
    """(seed, key, place, n_words, around) of the seeds of ``rows`` (key, text); ``around`` are the words near the seed.

    Without ``marks`` the rows are items, with the masks of their lengths. With ``marks``, a broadcast bitmap, they are
    texts with all ``used`` masks, and only seeds that it holds; a whole item that recurs in a text is one seed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = buffers(batch.column("text"))
            words, texts = word_hashes(data, offsets, LETTERS)
            firsts = np.searchsorted(texts, np.arange(len(batch) + 1))
            found = []
            sizes = np.diff(firsts)
            for salt in used:
                mask, least, most = _SEEDS[salt]
                seeds, at = window_hashes(words, texts, mask, salt)
                if marks is not None:
                    hit = may_hold(marks.value, seeds, BITMAP)
                else:
                    n = sizes[texts[at]]
                    hit = (n >= least) & (n <= (most or n))
                seeds, at = seeds[hit], at[hit]
                if marks is not None and len(mask) == most:
                    first = np.unique(np.stack([seeds, texts[at].astype(np.uint64)]), axis=1, return_index=True)[1]
                    seeds, at = seeds[first], at[first]
                found.append((seeds, at))
            seeds, at = (np.concatenate([x[k] for x in found]) for k in (0, 1))
            for k in range(0, max(len(seeds), 1), 20_000):
                s, a = seeds[k : k + 20_000], at[k : k + 20_000]
                text = texts[a]
                near = a[:, None] + np.arange(-_REACH, STRETCH)
                inside = (near >= firsts[text][:, None]) & (near < firsts[text + 1][:, None])
                around = np.where(inside, words[np.clip(near, 0, max(len(words) - 1, 0))] | np.uint64(1), np.uint64(0))
                flat = pa.array(around.view(np.int64).ravel())
                ends = pa.array(np.arange(0, flat.__len__() + 1, _REACH + STRETCH, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(s.view(np.int64)),
                        batch.column(key).take(pa.array(text)),
                        pa.array((a - firsts[text]).astype(np.int32)),
                        pa.array((firsts[text + 1] - firsts[text]).astype(np.int32)),
                        pa.ListArray.from_arrays(ends, flat),
                    ],
                    ["seed", key, "place", "n_words", "around"],
                )

    return rows.select(F.col(key), F.col("text").cast("string").alias("text")).mapInArrow(run, _SEED.format(key=f"{key} {kind}"))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps (key, item_id) of joined seeds whose surroundings agree."""
    for batch in batches:
        n = len(batch)
        ours, theirs = (np.asarray(batch.column(c).flatten()).reshape(n, _REACH + STRETCH) for c in ("around", "item_around"))
        same = np.cumsum(np.pad((ours == theirs) & (ours != 0), ((0, 0), (1, 0))), axis=1)
        best = (same[:, STRETCH:] - same[:, :-STRETCH]).max(axis=1, initial=0)
        need = np.ceil(AGREE * np.minimum(STRETCH, batch.column("item_words").to_numpy()))
        keep = pa.array(best >= need)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key").filter(keep), batch.column("item_id").filter(keep), pa.array(best[best >= need].astype(np.int32))],
            ["key", "item_id", "agree"],
        )


def copies(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, item_id, agree) of the items that stand in a text; key is the hash of the text, as ``text_key`` has it.

    ``agree`` is the most words of a stretch that agree. Words are runs of letters, digits and non-ASCII characters, A-Z
    lower-cased. Items with fewer words than a span are found where all their words stand; null texts have no words, and
    items without words are never found.
    """
    spark = docs.sparkSession
    used = _used(benchmark)
    items = _seeds(benchmark.select("item_id", "text"), "item_id", benchmark.schema["item_id"].dataType.simpleString(), used)
    marks = spark.sparkContext.broadcast(marked(items, "seed", BITMAP))
    seeds = _seeds(docs.select(text_key().alias("key"), "text"), "key", "string", used, marks)
    items = items.select(
        "seed", "item_id", F.col("n_words").alias("item_words"), F.col("around").alias("item_around"), F.col("place").alias("item_place")
    )
    # A seed of a text that many documents share, or that recurs within one, meets each item once per diagonal.
    once = seeds.dropDuplicates(["seed", "key", "place"])
    joined = once.join(items, "seed").select("key", "item_id", "around", "item_around", "item_words")
    found = joined.mapInArrow(_verify, f"key string, item_id {benchmark.schema['item_id'].dataType.simpleString()}, agree int")
    return found.groupBy("key", "item_id").agg(F.max("agree").alias("agree"))


def text_key():
    """128 bits that stand for a text, as a string: equal texts are searched once and share their result."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.concat_ws(":", F.hex(F.xxhash64(text)), F.hex(F.xxhash64(F.lit(1), text)))


def contamination(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row of ``docs``: ``keep``, contaminated (boolean), n_items (long), items (sorted array of item_id)."""
    found = copies(docs, benchmark).groupBy("key").agg(
        F.count("*").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("items")
    )
    row = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row")
    rows = docs.select(row, text_key().alias("key")).join(found, "key", "left")
    none = F.array().cast(found.schema["items"].dataType)
    return rows.select(
        "row.*",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items", none).alias("items"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item stands, with their columns."""
    found = copies(docs, benchmark).select("key").distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    return docs.select(row, text_key().alias("key")).join(found, "key", "left_anti").select("row.*")
