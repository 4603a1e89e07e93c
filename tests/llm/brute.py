"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UNCHANGED = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def folded(text: str | None) -> list[str]:
    return FOLDED.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination(docs, items, length=13):
    """Per row (id, n_words, n_hit, items, contaminated)."""
    windows = defaultdict(set)
    for item, text in items:
        words = folded(text)
        size = min(length, len(words))
        for i in range(len(words) - size + 1 if size and item is not None else 0):
            windows[tuple(words[i : i + size])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, found, hit = folded(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if owners := windows.get(tuple(words[i : i + size])):
                    found |= owners
                    hit.update(range(i, i + size))
        out.append((doc, len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)))
    return out


def repeats(docs, length=13):
    """Per row (id, n_words, kept words)."""
    first = {}
    order = lambda doc: float("inf") if doc is None else doc
    split = [(doc, UNCHANGED.findall(text or "")) for doc, text in docs]
    for doc, words in split:
        for i in range(len(words) - length + 1):
            key = tuple(words[i : i + length])
            first[key] = min(first.get(key, float("inf")), order(doc))
    out = []
    for doc, words in split:
        gone = set()
        for i in range(len(words) - length + 1):
            if first[tuple(words[i : i + length])] < order(doc):
                gone.update(range(i, i + length))
        out.append((doc, len(words), [w for i, w in enumerate(words) if i not in gone]))
    return out


def near_copies(docs, similarity=0.8):
    """Per row (id, class id, links)."""
    sets = []
    for _, text in docs:
        words = folded(text)
        size = min(5, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set())
    label, links = list(range(len(docs))), [0] * len(docs)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if both and both * 1000 >= round(similarity * 1000) * len(a | b):
                links[i] += 1
                links[j] += 1
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (doc, _), x in zip(docs, label):
        if doc is not None:
            least[x] = min(least.get(x, doc), doc)
    return [(doc, least.get(x), n) for (doc, _), x, n in zip(docs, label, links)]


def language_of(text, families, machines, size):
    """Language and score by plain votes; ``machines`` has weights and an offset for each pair of names."""
    if not any(map(str.isalpha, text or "")):
        return "und", 0.0
    data = [b + 32 if 65 <= b <= 90 else b for b in text.encode()]
    found = [0.0] * size
    for n in (1, 2, 3):
        for at in range(len(data) - n + 1):
            key = data[at]
            for b in data[at + 1 : at + n]:
                key = (key * 257 + b + 1) % 2**32
            found[key * 0x9E3779B1 % 2**32 * size // 2**32] += 1 / (len(data) - n + 1)
    margin = {
        pair: sum(w * (x / 3) ** 0.5 for w, x in zip(weights, found)) + offset
        for pair, (weights, offset) in machines.items()
    }

    def winner(names):
        own = {name: [m if name == a else -m for (a, b), m in margin.items() if name in (a, b)] for name in names}
        best = max(names, key=lambda name: (sum(m > 0 for m in own[name]), sum(own[name])))
        return best, [1 / (1 + math.exp(-4 * m)) for m in own[best]]

    family, first = winner(sorted(families))
    language, second = winner(families[family])
    return language, min([1.0, *first, *second])
