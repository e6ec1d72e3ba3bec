"""Plain Python versions of what the queries must return, written from the contracts alone."""

import hashlib
import re
from collections import Counter
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered), failed,
    )


PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def base_spans(text):
    """Lists of (start, end) per kind."""
    out = {}
    for kind, pattern in PATTERNS.items():
        out[kind] = []
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out[kind].append((m.start(), m.end()))
    return out


def base_hash(text):
    listed = ",".join(f"{k}:{s}:{e}" for k, v in base_spans(text).items() for s, e in v)
    return hashlib.sha256(listed.encode()).hexdigest()


# ---------------------------------------------------------------- near duplicates


def lower_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def shingles(text, n=4):
    words = lower_words(text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def components(docs):
    """{doc_id: (n_shingles, component_id)} from rows (doc_id, text), over all pairs.

    An inverted index lists the pairs that share anything; no other pair can be similar.
    """
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    first = {}
    for d in sorted(sets):
        if sets[d]:
            other = first.setdefault(sets[d], d)
            root[find(d)] = find(other)
    index = {}
    for d in first.values():
        shared = Counter()
        for s in sets[d]:
            for other in index.setdefault(s, []):
                shared[other] += 1
            index[s].append(d)
        for other, both in shared.items():
            if 100 * both >= 80 * (len(sets[d]) + len(sets[other]) - both):
                a, b = sorted((find(d), find(other)))
                root[b] = a
    smallest = {}
    for d in sorted(sets):
        smallest.setdefault(find(d), d)
    return {d: (len(sets[d]), smallest[find(d)]) for d in sets}


# ---------------------------------------------------------------- mixing


def targets(sizes, weights=(5, 2, 1), share=Fraction(3, 2), limit=2):
    """{source: target} as fractions, from {source: size}; null comes last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > limit * sizes[s]}
        for s in full or open_:
            out[s] = Fraction(limit * sizes[s]) if full else unit * weight[s]
        left -= sum(out[s] for s in full)
        open_ -= full or set(open_)
    return out
