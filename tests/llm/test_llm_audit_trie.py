"""Prefix trie and filter audit against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from formtide.llm import audit, prefixes


def plain_trie(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            kind = f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()
            convs[conv_id].append((turn is not None, turn or 0, hashlib.sha256(kind).digest(), (role or "", text or "")))
    turns = {c: [x[3] for x in sorted(ts, key=lambda x: x[:3])] for c, ts in convs.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        whole[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for path, cs in members.items():
        weight = (len(cs) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += weight
            leaves[path[:d]] += children[path] == 0
    return Counter(
        (
            min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, cs in members.items()
    )


TURNS = "conv_id long, turn long, role string, text string, node string, block string, key string"


def trie_rows(spark, rows):
    df = spark.createDataFrame([(*r, "x", None, "y") for r in rows], TURNS).repartition(3)
    return Counter(tuple(r) for r in prefixes.trie(df).collect())


def test_trie_of_shared_starts(spark):
    rng = random.Random(5)
    rows = []
    for c in list(range(40)) + [-3, -10, 2**40]:
        for t in range(rng.randrange(1, 14)):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", None, "bot"]), rng.choice(["", None, "a", "é", "b c"])))
    rows += rows[:5] + [(None, 1, "user", "lost")]
    assert trie_rows(spark, rows) == plain_trie(rows)


def test_trie_of_long_conversations_and_copies(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "RUN", 3)
    monkeypatch.setattr(prefixes, "PACK", 4)
    rows = [(c, t, "user", str(t % 7)) for c in range(12) for t in range(230 if c % 3 else 231)]
    rows += [(100 + c, t, "bot", "same") for c in range(15) for t in range(2)]
    assert trie_rows(spark, rows) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert prefixes.trie(spark.createDataFrame([], TURNS)).collect() == []


def plain_audit(docs, labels):
    first = {}
    for doc_id, _, text in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    parts = defaultdict(list)
    for doc_id, source, text in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > first[text],
        }
        parts[source or ""].append((fails, doc_id in good, doc_id in toxic))
    out = {}
    for part, rows in parts.items():
        total = Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, x in enumerate(order, 1):
                gone, stay = [r for r in left if r[0][x]], [r for r in left if not r[0][x]]
                failing = [r for r in rows if r[0][x]]
                alone = sum(sum(r[0].values()) == 1 for r in failing)
                total[x] += len(gone)
                out[part, "".join(order), step] = [len(stay), len(gone), len(failing) - len(gone), alone, sum(r[1] for r in gone), sum(r[2] for r in gone)]
                left = stay
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


DOCS = "doc_id long, source string, text string, part string, bits int, good string"
LABELS = "doc_id long, quality int, toxic int"


def test_audit_against_all_orders(spark):
    rng = random.Random(3)
    texts = [None, "", "word " * 300, "ABC def", "#"] + [" ".join(rng.choice(["a", "B", "c%", "é", "x y"]) + str(rng.randrange(n)) for _ in range(230)) for n in (3, 400, 400)]
    docs = [(rng.choice([None, *range(60)]), rng.choice([None, "", "s", "t"]), rng.choice(texts)) for _ in range(200)]
    docs += docs[:9]
    labels = [(d, rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for d in [*range(0, 60, 2), *range(0, 60, 5), None, 999]]
    got = audit.interactions(
        spark.createDataFrame([(*d, "clash", 7, "clash") for d in docs], DOCS).repartition(3), spark.createDataFrame(labels, LABELS)
    ).collect()
    assert {tuple(r) for r in got} == plain_audit(docs, labels)
    assert len(got) == 3 * 600


def test_audit_of_nothing(spark):
    assert audit.interactions(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []


@pytest.mark.parametrize("segment", [1, 7, 1 << 20])
def test_words_across_segments(monkeypatch, segment):
    monkeypatch.setattr(audit, "SEGMENT", segment)
    for text in (b"", b"  ", b"a bb\x0ba  ccc\n", b"x" * 50 + b" " * 20 + b"a a"):
        words = re.findall(rb"[^\x20\x09-\x0D]+", text)
        assert audit._words(text) == (len(words), len(set(words)))


def test_contraction_selects_along_each_axis():
    cells = np.random.default_rng(1).integers(0, 99, (3, 2, 2, 2, 2, 2))
    counts = audit.step_counts(cells)
    row = audit.ORDERS.index("CAEBD") * 5 + 2  # step 3: E, after C and A
    assert counts["removed"][row] == cells[0, 0, :, 0, :, 1].sum()
    assert counts["kept"][row] == cells[0, 0, :, 0, :, 0].sum()
    assert counts["redundant"][row] == cells[0, :, :, :, :, 1].sum() - counts["removed"][row]
    assert counts["unique_fails"][row] == cells[0, 0, 0, 0, 0, 1]
    assert counts["good_lost"][row] == cells[1, 0, :, 0, :, 1].sum()
