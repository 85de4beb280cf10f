"""The Katz model against a plain version, and its probabilities against one."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from formtide.llm import katz

K = katz.GOOD_TURING


def plain_discounts(counts):
    n = Counter(counts)
    common = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    out = {}
    for r in range(1, K + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common != 1 else 0
        out[r] = d if 0 < d < 1 else r / (r + 1)
    return out


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


class PlainModel:
    def __init__(self, texts):
        self.one, self.two = Counter(), defaultdict(Counter)
        for text in texts:
            before = "<s>"
            for token in [*re.findall(r"[^\x20\x09-\x0D]+", lower(text)), "</s> "]:
                self.one[token] += 1
                self.two[before][token] += 1
                before = token
        self.n = sum(self.one.values())
        self.d1 = plain_discounts(self.one.values())
        self.d2 = plain_discounts([c for row in self.two.values() for c in row.values()])
        left = sum(c * (1 - self.d1.get(c, 1)) for c in self.one.values())
        self.total = self.n + (1 if left <= 0 else 0)
        self.unknown = (left if left > 0 else 1) / self.total

    def p1(self, w):
        c = self.one[w]
        return self.d1.get(c, 1) * c / self.total if c else self.unknown

    def p2(self, w, v):
        row = self.two.get(v)
        if not row:
            return self.p1(w)
        left = sum(c * (1 - self.d2.get(c, 1)) for c in row.values())
        total = sum(row.values()) + (1 if left <= 0 else 0)
        if row[w]:
            return self.d2.get(row[w], 1) * row[w] / total
        return (left if left > 0 else 1) / total / (1 - sum(self.p1(x) for x in row if row[x])) * self.p1(w)


def plain_scores(docs):
    held = [zlib.crc32(str("" if d is None else d).encode()) % 7 == 2 for d, _ in docs]
    model = PlainModel([t for (_, t), h in zip(docs, held, strict=True) if not h])
    out = []
    for (doc_id, text), h in zip(docs, held, strict=True):
        words, before, base, score, known = [*re.findall(r"[^\x20\x09-\x0D]+", lower(text)), "</s> "], "<s>", 0.0, 0.0, 0
        for w in words:
            base += math.log10((model.one[w] + 1) / (model.n + len(model.one) + 1))
            score += math.log10(model.p2(w, before))
            known += model.one[w] > 0
            before = w
        out.append((doc_id, h, len(words), known, model.n, base, score))
    return model, out


SCHEMA = "doc_id long, text string, row string, piece string, held_out string"


def check(spark, docs):
    df = spark.createDataFrame([(*d, "r", None, "h") for d in docs], SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in katz.score_documents(df).collect()), key=repr)
    want = sorted(plain_scores(docs)[1], key=repr)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:5], round(r[5], 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want, strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


def corpus(rng, n):
    words = ["a", "B", "the", "É", "x\x00y", "tail"] + [f"w{k}" for k in range(60)]
    weights = [40, 20, 20, 5, 1, 1] + [6 / (k + 1) for k in range(60)]
    texts = [None, "", " \n", "The  a\tb\x0bA"] + [" ".join(rng.choices(words, weights, k=rng.randrange(1, 60))) for _ in range(n)]
    docs = [(k, t) for k, t in enumerate(texts)] + [(None, "a b"), (None, None)]
    docs += [(1000 + k, "copied words that no other text has at all") for k in range(20)]  # contexts without a discount
    return docs + docs[4:8]


def test_scores_against_a_plain_model(spark):
    check(spark, corpus(random.Random(1), 150))


def test_scores_in_many_pieces_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(katz, "PIECE", 50)
    monkeypatch.setattr(katz, "BUCKET", 40)
    monkeypatch.setattr(katz, "WORDS", 5)
    monkeypatch.setattr(katz, "SEGMENT", 16)
    docs = corpus(random.Random(2), 60)
    docs.append((5000, " ".join(random.Random(3).choices(["a", "b", "one", "far"], k=900))))  # over many pieces
    check(spark, docs)


def test_scores_without_training_or_rows(spark):
    held = next(k for k in range(99) if zlib.crc32(str(k).encode()) % 7 == 2)
    check(spark, [(held, "a b"), (held, None)])
    assert katz.score_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_every_context_sums_to_one(spark):
    docs = corpus(random.Random(4), 120)
    df = spark.createDataFrame([(d, t, False) for d, t in docs], "doc_id long, text string, held_out boolean")
    model, _ = katz.fit_and_score(df)
    ids = np.array([katz.END, katz.UNKNOWN, *(r["id"] for r in model.vocabulary.collect())])
    single = dict(zip(ids.tolist(), model.unigrams.probability(ids), strict=True))
    assert sum(single.values()) == pytest.approx(1)
    rows = defaultdict(dict)
    for r in model.bigrams.collect():
        cells = [katz.unpack(r[c]) for c in ("contexts", "tokens", "counts")]
        for v, w, c in zip(np.cumsum(cells[0]).tolist(), cells[1].tolist(), cells[2].tolist(), strict=True):
            rows[v][w] = c
    weights = {r["context"]: r for r in model.contexts.collect()}
    assert weights.keys() == rows.keys() and len(rows) > 50
    d = [*model.discount, 1.0]
    for v, row in rows.items():
        assert weights[v]["total"] == sum(row.values())
        total = sum(row.values()) * 10 ** weights[v]["shift"]
        seen = sum(d[min(c, K + 1)] * c / total for c in row.values())
        rest = sum(p for w, p in single.items() if w not in row) * 10 ** weights[v]["backoff"]
        assert seen + rest == pytest.approx(1)


def test_held_out_texts_fare_better_than_by_words_alone(spark):
    rng = random.Random(9)
    follow = {w: rng.sample(range(50), 3) for w in range(50)}

    def text():
        at = rng.randrange(50)
        return " ".join(f"w{(at := rng.choice(follow[at]))}" for _ in range(40))

    rows = katz.score_documents(spark.createDataFrame([(k, text()) for k in range(400)], "doc_id long, text string")).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > 0.6 * sum(r["base_score"] for r in rows)
