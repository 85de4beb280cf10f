"""Plain versions of the operators, for small inputs: exact, quadratic where that is simplest, and without Spark."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def quality(text: str | None) -> tuple:
    text = text or ""
    words = SPACE.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def boilerplate(rows: list[tuple], ratio=0.1) -> list[str | None]:
    """Texts of rows (host, text) without lines on over ``ratio`` of the host's different texts, and on two at least."""
    texts, carry = defaultdict(set), defaultdict(set)
    for host, text in rows:
        texts[host or ""].add(text or "")
        for line in (text or "").split("\n"):
            carry[host or "", line.strip(" ")].add(text or "")

    def stays(host, line):
        pages = len(carry[host or "", line])
        return not line or pages < 2 or pages <= ratio * len(texts[host or ""])

    return [None if text is None else "\n".join(x for x in text.split("\n") if stays(host, x.strip(" "))) for host, text in rows]


def shingle_set(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def similar(docs: list[tuple]) -> dict:
    """id -> (shingles, component) for rows (id, text) with ids of their own."""
    sets = {d: shingle_set(t) for d, t in docs}
    found = {d: d for d in sets}

    def root(x):
        while found[x] != x:
            x = found[x]
        return x

    index = defaultdict(list)
    for d, s in sets.items():
        for e, n in Counter(e for g in s for e in index[g]).items():
            if 100 * n >= 75 * (len(s) + len(sets[e]) - n):
                a, b = root(d), root(e)
                found[max(a, b)] = min(a, b)
        for g in s:
            index[g].append(d)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def copies(docs: list[tuple], items: list[tuple], masks, span: int, stretch: int, agree: float) -> dict:
    """id -> sorted items, by spaced seeds and the stretch around them."""
    split = lambda t: re.findall(rb"[a-z0-9\x80-\xff]+", (t or "").encode().lower())
    texts = {i: split(t) for i, t in items}
    seeds = defaultdict(list)
    for i, w in texts.items():
        for m, mask in enumerate(masks):
            for p in range(len(w) - span + 1):
                seeds[(m, *(w[p + j] for j in mask))].append((i, p))
    out = {}
    for d, t in docs:
        w, got = split(t), set()
        for m, mask in enumerate(masks):
            for p in range(len(w) - span + 1):
                for i, q in seeds.get((m, *(w[p + j] for j in mask)), ()):
                    b = texts[i]
                    same = [0 <= p + k < len(w) and 0 <= q + k < len(b) and w[p + k] == b[q + k] for k in range(span - stretch, stretch)]
                    best = max(sum(same[s : s + stretch]) for s in range(len(same) - stretch + 1))
                    if 100 * best >= round(100 * agree) * min(stretch, len(b)):
                        got.add(i)
        out[d] = sorted(got)
    return out


def without_repeats(docs: list[tuple], length: int = 50) -> dict:
    """id -> (bytes, removed, spans, what is left) for rows (id, text) with ids of their own."""
    texts, first = {d: (t or "").encode() for d, t in docs}, {}
    for d in sorted(texts):
        for i in range(len(texts[d]) - length + 1):
            first.setdefault(texts[d][i : i + length], d)
    out = {}
    for d, b in texts.items():
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)
    return out


def luhn(digits: str) -> bool:
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def private(text: str | None) -> list[tuple]:
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [
        (m.start(), 1, m.end())
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m[0].split("."))
    ]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [
        (m.start(), 3, m.end())
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15
    ]
    return sorted(found)


def license_words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def license_base(text: str | None, phrases) -> list[tuple[int, str]]:
    words, found = license_words(text), []
    for phrase, label in phrases:
        parts = phrase.split()
        found += [(i, label) for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
    return sorted(found)


def license_coverage(text: str | None, templates, k: int, near: int, least: float) -> dict[str, float]:
    """label -> best coverage of verified spans."""
    words, best = license_words(text), {}
    for label, template in templates:
        parts = template.split()
        hits = [
            (i - j, j, i) for j in range(len(parts) - k + 1) for i in range(len(words) - k + 1) if parts[j : j + k] == words[i : i + k]
        ]
        groups: list[list[tuple]] = []
        for hit in sorted(hits):
            if groups and hit[0] - groups[-1][-1][0] <= near:
                groups[-1].append(hit)
            else:
                groups.append([hit])
        for group in groups:
            share = len({j + x for _, j, _ in group for x in range(k)}) / len(parts)
            extent = max(i for *_, i in group) + k - 1 - min(i for *_, i in group)
            if share >= least and extent < 1.5 * len(parts):
                best[label] = max(best.get(label, 0), share)
    return best
