"""Operators on whole corpora: Jaccard join, decontamination, repeated strings, components, and the pipeline."""

import itertools
import random
from collections import Counter

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from formtide.llm import bpe, decontaminate, jaccard, quality, substrings, tokens
from formtide.llm.graph import components

DOCS = "doc_id long, text string, key string, node string, item_id long, n int"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "k", None, 1, 2) for r in rows], DOCS).repartition(parts)


def family_texts(seed: int, n: int) -> list[tuple]:
    """Families of edited, cut and copied texts, with short, empty and null ones."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["Été", "X"]
    base = [[r.choice(vocabulary) for _ in range(r.choice([3, 6, 20, 60, 120]))] for _ in range(15)]
    rows = []
    for k in range(n):
        words = list(r.choice(base))
        for _ in range(r.randint(0, max(1, len(words) // 15))):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        if r.random() < 0.2:
            words = words[: r.randint(0, len(words))]
        rows.append((3 * k + 1, " ".join(words)))
    return [*rows, (5000, None), (5001, ""), (5002, " \n"), (5003, "a b"), (5004, "A  b"), (5005, "long " * 50_000)]


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 340)] + [(500, 500), (None, 3)]
    root = {x: x for e in edges if None not in e for x in e}
    for _ in range(len(root)):
        for a, b in (e for e in edges if None not in e):
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(edges, "a int, b int")).collect()
    assert {x.node: x.component for x in got} == root and len(got) == len(root)


@pytest.mark.parametrize("listed", [32, 4, 2])
def test_jaccard_join(spark, monkeypatch, listed):
    """With every pair of short rows at once, and with rows of the matrix that first meet one group only."""
    monkeypatch.setattr(jaccard, "LIST", listed)
    monkeypatch.setattr(jaccard, "BUCKET", 20_000)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rows = family_texts(5, 350)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(frame(spark, rows)).collect()}
    assert got == brute.similar(rows)


def test_jaccard_meetings(spark):
    """Texts whose first common shingle stands too far back in both for a link don't meet, and those with enough after it do."""

    def meet(places):
        texts = [" ".join(f"{k}x{i}" if i < place else f"same{i}" for i in range(44)) for k, place in enumerate(places)]
        rows = spark.createDataFrame([(k, str(k), t) for k, t in enumerate(texts)], "id long, key string, text string")
        hashes = [tokens.shingles(pa.array([t]))[0] for t in texts]
        common = np.intersect1d(*hashes)  # as the most frequent ones they are the last of each text
        heads = jaccard._heads(rows, common)
        assert heads.columns == ["id", "key", "heads", "spots"]  # no text goes on from here
        matrix = jaccard._matrix(heads.withColumnRenamed("id", "group"), 3)
        return {frozenset((r.a, b)) for r in jaccard._meetings(matrix).collect() for b in r.bs}

    assert meet([4, 4]) == {frozenset((0, 1))}
    assert meet([8, 8]) == set()


def test_jaccard_chance_meetings_are_no_candidates(spark, monkeypatch):
    """Texts that share one rare shingle each with many others are not compared; a near copy of one still is."""
    asked = []
    verified = jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda docs, pairs, keys: asked.append(pairs.count()) or verified(docs, pairs, keys))
    words = [[f"w{k}x{i}" for i in range(20)] for k in range(24)]
    for k, j in itertools.combinations(range(24), 2):
        words[k] += [f"c{k}y{j}z{i}" for i in range(5)]
        words[j] += [f"c{k}y{j}z{i}" for i in range(5)]
    rows = [(k, " ".join(w)) for k, w in enumerate(words)] + [(100, " ".join(words[0][:-2]))]
    got = {r.doc_id: r.component_id for r in jaccard.similar_groups(frame(spark, rows)).collect()}
    assert got == {k: k for k in range(24)} | {100: 0}
    assert sum(asked) <= 2


def test_jaccard_frequent_shingles(spark, monkeypatch):
    counts = spark.createDataFrame([(k, 1 + k % 5) for k in range(100)], "shingle long, times long")
    monkeypatch.setattr(jaccard, "FREQUENT", 50)
    assert list(jaccard._frequent(counts)) == [*range(4, 100, 5), *range(3, 100, 5)]
    monkeypatch.setattr(jaccard, "FREQUENT", 7)
    assert list(jaccard._frequent(counts)) == [*range(4, 35, 5)]
    assert len(jaccard._frequent(counts.limit(0))) == 0


def test_jaccard_ties(spark):
    """Repeated rows and ids link by their texts; rows without an id take part; an empty table has no rows."""
    text = "one two three four five six seven"
    rows = [(7, text), (7, text), (7, "other words of the same id are here"), (None, text.upper()), (9, text), (None, None)]
    got = Counter(tuple(r) for r in jaccard.similar_groups(frame(spark, rows)).collect())
    assert got == Counter([(7, 3, 7)] * 2 + [(7, 4, 7), (None, 3, 7), (9, 3, 7), (None, 0, None)])
    assert jaccard.similar_groups(frame(spark, rows).limit(0)).count() == 0


def test_words_across_segments(monkeypatch):
    """Hashes don't depend on where a long text is cut for hashing."""
    import pyarrow as pa

    column = pa.array(["ab cd  efg " * 300, None, "", "x" * 500, "ab cd efg h i"])
    whole = [x.tolist() for x in tokens.shingles(column)]
    monkeypatch.setattr(tokens, "SEGMENT", 64)
    assert [x.tolist() for x in tokens.shingles(column)] == whole


def benchmark_items() -> list[tuple]:
    r = random.Random(8)
    return [(k, " ".join(f"q{r.randrange(80)}" for _ in range(r.choice([5, 12, 15, 30, 60])))) for k in range(25)] + [(90, None), (91, "")]


def leaking_texts(items: list[tuple]) -> list[tuple]:
    r = random.Random(9)
    rows = []
    for k in range(150):
        words = [f"q{r.randrange(80)}" for _ in range(r.randint(0, 80))]
        if k % 2:
            copy = (r.choice(items)[1] or "").split()
            for _ in range(r.randint(0, len(copy) // 4)):
                copy[r.randrange(len(copy))] = "changed"
            at = r.randint(0, len(words))
            words[at:at] = copy[: r.randint(len(copy) // 2, len(copy))]
        rows.append((k, ", ".join(words).upper() if k % 3 else " ".join(words)))
    return [*rows, (400, None), (401, ""), (402, "x" * 100_000), (403, "q1 " * 30_000)]


def test_decontamination(spark):
    items = benchmark_items()
    rows = leaking_texts(items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute.copies(rows, items, decontaminate.MASKS, decontaminate.SPAN, decontaminate.STRETCH, decontaminate.AGREE)
    docs = frame(spark, [*rows, rows[1], (None, rows[3][1])])
    got = Counter((r.doc_id, tuple(r["items"]), r.n_items, r.contaminated) for r in decontaminate.contamination(docs, bench).collect())
    tuples = [*((d, tuple(i)) for d, i in expected.items()), (1, tuple(expected[1])), (None, tuple(expected[3]))]
    assert got == Counter((d, i, len(i), bool(i)) for d, i in tuples)
    assert 20 < sum(map(bool, expected.values())) < 100
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(d for d, i in tuples if not i)
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_every_tolerated_substitution_is_seeded():
    """All places of the words that may differ, for every length, without hashes."""
    for n in range(1, 61):
        size = min(n, decontaminate.STRETCH)
        masks = [m for m, least, most in decontaminate._SEEDS if least <= n <= (most or n)]
        windows = [{at + j for j in m} for m in masks for at in range(size - m[-1])]
        need = -(-round(100 * decontaminate.AGREE) * size // 100)
        for changed in itertools.combinations(range(size), size - need):
            assert any(w.isdisjoint(changed) for w in windows), (n, changed)


def on_all_diagonals(docs: list[tuple], items: list[tuple]) -> dict:
    """id -> sorted items, by comparing every stretch of every diagonal; words are blank-separated."""
    out = {}
    for d, t in docs:
        w, got = t.split(), []
        for i, text in items:
            b = text.split()
            need = -(-round(100 * decontaminate.AGREE) * min(decontaminate.STRETCH, len(b)) // 100)
            for shift in range(-len(b) + 1, len(w)):
                same = [0 <= shift + k < len(w) and w[shift + k] == b[k] for k in range(len(b))]
                if max(sum(same[k : k + decontaminate.STRETCH]) for k in range(len(b))) >= need:
                    got.append(i)
                    break
        out[d] = sorted(got)
    return out


def test_decontamination_finds_all_that_agrees(spark):
    """Items of every length with as many substituted words as may differ or one more, cut by the ends of texts or not."""
    r = random.Random(12)
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in [*range(1, 23), 40]]
    rows = []
    for n, text in items:
        size = min(n, decontaminate.STRETCH)
        for extra in (0, 0, 0, 0, 1):
            start = r.randint(0, n - size)
            words = text.split()[start : start + size]
            for k in r.sample(range(size), size - -(-80 * size // 100) + extra):
                words[k] = "changed"
            around = [f"o{k}" for k in range(r.choice([0, 0, 2, 25]))]
            rows.append((len(rows), " ".join([*around, *words, *around[: r.choice([0, 30])]])))
        rows.append((len(rows), " ".join(text.split()[: -(-80 * size // 100)])))
    rows.append((len(rows), "i1w0 i2w0 i2w1 " * 500))
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = on_all_diagonals(rows, items)
    assert {r.doc_id: r["items"] for r in decontaminate.contamination(frame(spark, rows), bench).collect()} == expected
    assert {i for found in expected.values() for i in found} == {n for n, _ in items}


def repeating_texts() -> list[tuple]:
    r = random.Random(2)
    words = ["the", "and", "alpha", "é", "beta", "gamma", "x" * 30]
    base = [" ".join(r.choice(words) for _ in range(60)) for _ in range(8)]
    rows = []
    for k in range(200):
        text = r.choice(base)
        at = r.randint(0, len(text))
        text = text[at : at + r.randint(0, 200)] + " ".join(r.choice(words) for _ in range(r.randint(0, 40)))
        rows.append((r.randint(0, 10**6) * 300 + k, "For " * r.randint(10, 300) if r.random() < 0.1 else text))
    return [*rows, (5, None), (6, ""), (7, "a" * 500), (8, "a" * 49), (9, "a" * 50), (10, "b" * 49 + "c"), (11, "b" * 49 + "c" * 3000)]


@pytest.mark.parametrize("frequent", [1e-3, 1.0])
def test_repeated_strings(spark, monkeypatch, frequent):
    """In many pieces and buckets, with and without anchors that count as frequent."""
    monkeypatch.setattr(substrings, "PIECE", 4000)
    monkeypatch.setattr(substrings, "BUCKET", 3000)
    monkeypatch.setattr(substrings, "FREQUENT", frequent)
    rows = repeating_texts()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in substrings.remove_repeats(frame(spark, rows)).collect()}
    assert got == brute.without_repeats(rows)


def test_repeated_strings_of_shared_ids(spark):
    """Rows of one id don't take from each other, rows without an id stay whole."""
    a, b = "abcdefghij" * 6, "0123456789" * 7
    rows = [(1, a), (1, a + b), (2, b), (2, "tail " + a), (None, a), (None, a), (3, a), (3, a)]
    got = Counter((r.doc_id, bytes(r.kept).decode(), r.n_removed) for r in substrings.remove_repeats(frame(spark, rows)).collect())
    assert got == Counter([(1, a, 0), (1, a + b, 0), (2, "", 70), (2, "tail ", 60), (None, a, 0), (None, a, 0), (3, "", 60), (3, "", 60)])
    assert substrings.remove_repeats(frame(spark, rows).limit(0)).count() == 0


def test_blind_trie():
    r = random.Random(3)
    data = bytes(r.choice(b"ab") for _ in range(600))
    positions = list(range(500))
    got = substrings.blind_trie(data, positions, 2, 12)
    assert sorted(p for x in got for p in x) == positions
    keys = [{data[p + 2 : p + 12] for p in x} for x in got]
    assert all(len(k) == 1 for k in keys)
    ordered = [k.pop() for k in keys]
    assert ordered == sorted(set(ordered))


def plain_pipeline(rows: list[tuple], items: list[tuple]) -> Counter:
    """rows: (doc_id, text, lang, source, n_chars), ids unique."""
    good = []
    for d, t, lang, source, _ in rows:
        n, chars, symbols, dup, repeat = brute.quality(t)
        lines = sum(1 for x in (t or "").split("\n") if brute.SPACE.search(x))
        upper = sum("A" <= c <= "Z" for c in t or "")
        rules = {
            "few_words": n < 50, "repeated_words": 100 * repeat > 50 * n, "many_symbols": 100 * symbols > 10 * n, "long_words": chars > 10 * n,
            "short_words": chars < 3 * n, "repeated_lines": 100 * dup > 50 * lines, "shouting": 100 * upper > 30 * chars,
        }
        assert set(rules) == set(quality.BIT)
        if not any(rules.values()):
            good.append((d, t, lang, source))
    texts = brute.boilerplate([(s, t) for _, t, _, s in good])
    kept = [(d, t, lang, s) for (d, _, lang, s), t in zip(good, texts, strict=True)]
    first = brute.similar([(d, t) for d, t, *_ in kept])
    kept = [x for x in kept if first[x[0]][1] == x[0]]
    found = brute.copies([(d, t) for d, t, *_ in kept], items, decontaminate.MASKS, decontaminate.SPAN, decontaminate.STRETCH, decontaminate.AGREE)
    ranks = bpe.parse_ranks(corpus_pipeline.read_bytes(corpus_pipeline.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = Counter()
    for d, t, lang, source in kept:
        if not found[d]:
            ids = library.encode_ordinary(t or "")
            out[d, lang, source, len(ids), brute.sha(",".join(map(str, ids)).encode()), brute.sha((t or "").encode())] += 1
    return out


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, folder).collect()) == plain_pipeline(rows, items)


def test_pipeline_stages_keep_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, key string"
    texts = [None, "", *(f"{'some plain words that nobody would object to ' * 2}number {k} with " + " ".join(f"w{k}x{j}" for j in range(60)) for k in range(6))]
    docs = spark.createDataFrame([(k, t, "en", None, None, "r", "k") for k, t in enumerate(texts)] * 2, schema)
    for empty in (False, True):
        step = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            step = stage(spark, step, "/root/testdata/sf0.001")
            assert step.columns == docs.columns
        step = corpus_pipeline.STAGES[-1][1](spark, step, "/root/testdata/sf0.001")
        assert Counter(r.doc_id for r in step.collect()) == ({} if empty else Counter(range(2, 8)))  # of two equal rows one stays


def test_fixed_bitmaps_only_save_work(spark, monkeypatch):
    """A bitmap that is far too small changes no result."""
    items = benchmark_items()
    rows = leaking_texts(items)[:60]
    bench = spark.createDataFrame(items, "item_id long, text string")
    take = lambda: {r.doc_id: list(r["items"]) for r in decontaminate.contamination(frame(spark, rows), bench).collect()}
    before = take()
    monkeypatch.setattr(decontaminate, "BITMAP", 7)
    assert take() == before
