"""Decontamination, hard negatives and lexical search against plain Python, on hand-made rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeframe.llm import decontamination, hard_negatives, lexical_search
from gaugeframe.llm.terms import CHUNK, TERM, terms_of

DOCS = "doc_id long, text string, lang string, w string, t1 long, k int, words string, items string"
EXTRA = ("en", "x", 1, 2, "y", "z")
WORDS = [f"w{i}" for i in range(60)] + ["Ünder", "日本", "don't", "A1", "b"]


def lowered_terms(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(TERM, lower)


def made_texts(seed=1, n=60):
    rng = random.Random(seed)
    return [None, "", "...", "b", "ünder Ünder"] + [
        rng.choice([" ", "\n", ", "]).join(rng.choices(WORDS, k=rng.choice([1, 3, 9, 10, 30, 80]))) for _ in range(n)
    ]


@pytest.mark.parametrize("texts", [made_texts(), ["x" * (2 * CHUNK + 7) + " y", "y", None, "ab", "cd"]])
def test_terms(texts):
    seen = {}
    rows = []
    for t in terms_of(pa.array(texts, pa.string())):
        for a, b in zip(t.first, t.first[1:]):
            found = t.text(a, b).split(" ") if b > a else []
            rows.append(found)
            assert all(seen.setdefault(w, h) == h for w, h in zip(found, t.hashes[a:b]))
    assert rows == [lowered_terms(t) for t in texts]
    assert len(set(seen.values())) == len(seen)


# ---------------------------------------------------------------- decontamination


def brute_contamination(text, items, window=10):
    words = lowered_terms(text)
    hit, found = set(), set()
    for item_id, item in items:
        own = lowered_terms(item)
        m = min(window, len(own))
        for w in {tuple(own[i : i + m]) for i in range(len(own) - m + 1)} if m else ():
            for i in range(len(words) - m + 1):
                if tuple(words[i : i + m]) == w:
                    hit.update(range(i, i + m))
                    if item_id is not None:
                        found.add(str(item_id))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("bits", [26, 8])  # eight bits tell next to nothing apart
@pytest.mark.parametrize("seed", [3, 4])
def test_decontamination_equals_brute_force(spark, seed, bits):
    rng = random.Random(seed)
    texts = made_texts(seed)
    long_ = " ".join(rng.choices(WORDS, k=3000))
    passage = long_.split()[40:75]
    hot = " ".join(WORDS[:14])
    items = [
        (1, " ".join(passage)), (2, "w1 w2 W3"), (3, "b"), (None, hot), (5, None), (6, "!"), (7, hot), (7, "w5 w6"),
        (7, "w5 w6"), (10, " ".join(WORDS[5:18])), (11, "w9 " * 25), (12, "never anywhere here"),
    ]
    texts += [long_, long_, "w9 " * 12, f"{hot} and {hot} {hot}", "w1 w2 w3 w4", *[f"q{i} {hot}" for i in range(30)]]
    rows = [(None if i == 7 else i // 2, t, *EXTRA) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS)
    asked = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, doc_id string")
    p = decontamination.Decontamination(bitmap_bits=bits)
    got = decontamination.contamination(docs, asked, p).collect()
    expected = Counter((r[0], *map(str, brute_contamination(r[1], items))) for r in rows)
    assert Counter((r.doc_id, str(r.n_words), str(r.n_hit), str(r["items"])) for r in got) == expected
    assert all(sum(s.end - s.begin for s in r.spans) == r.n_hit for r in got)
    digest = decontamination.digest(docs, asked).where("n_items > 0").first()
    assert digest.contaminated and len(digest.items_sha256) == 64


def test_decontamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c", *EXTRA)], DOCS)
    items = spark.createDataFrame([], "item_id long, text string")
    row = decontamination.digest(docs, items).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (3, 0, 0, False)
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest()
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontamination.digest(docs.limit(0), some).count() == 0


def test_shingles_join_by_their_rarest(spark):
    """Of a window only its rarest shingle is looked up."""
    windows = decontamination.windows_of(
        spark.createDataFrame([(1, "a b c d e")], "item_id long, text string"),
        decontamination.Decontamination(window=5, shingle=2), "item_id", "text",
    )
    assert [(r.w, r.m, r.k) for r in windows.collect()] == [("a b c d e", 5, 2)]
    held = spark.createDataFrame(
        [(1, 1, 2, "x a b c d e".split(), 1), (2, 2, 2, "a b c d".split(), 9), (3, 3, 2, "d e a b".split(), 4)],
        "p1 long, p2 long, k int, words array<string>, n long",
    )
    found = decontamination.occurrences(held, windows).collect()
    assert [(r.p1, r.begin, r.end) for r in found] == [(1, 1, 6)]


# ---------------------------------------------------------------- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, score double, anchor string"


def brute_negatives(rows, p=5, n=10, low=30, high=90):
    vectors = [
        (i, tuple(math.floor(256 * x) for x in map(float, map(np.float32, v))), label)
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = Counter()
    for anchor, a, label in sorted({v for v in vectors if v[0] % 100 == 0}):
        scored = sorted(
            (-sum(x * y for x, y in zip(a, b)), i, other)
            for i, b, other in vectors if i != anchor and len(a) == len(b)
        )
        for ps, positive, _ in [s for s in scored if s[2] == label][:p]:
            inside = [s for s in scored if s[2] != label and 30 * -ps <= 100 * -s[0] <= 90 * -ps]
            for rank, (ns, negative, _) in enumerate(inside[:n], start=1):
                out[(anchor, positive, rank, negative, -ps, -ns)] += 1
    return out


def made_vectors(seed, n=260, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(3, 6))
    rows = []
    for i in range(n):
        v = (centres[i % 3] + 0.6 * rng.normal(size=6)) * scale
        v = np.round(v, 1) if i % 2 else v  # ties
        rows.append([i, [float(np.float32(x)) for x in v], int(rng.integers(0, 4))])
    rows[3][1], rows[5][1][2], rows[7][1][0], rows[9][1] = None, None, float("nan"), []
    rows[11][2], rows[13][0] = None, None
    rows[15][1], rows[17][1] = [1.0, 2.0], [float("inf")] * 6
    rows[100][1] = list(rows[1][1])  # an anchor equal to other rows
    rows += [list(rows[20]), list(rows[20]), list(rows[0]), [200, [0.0] * 6, 1], [300, [1.0, 1.0], 2], [301, [2.0, 1.0], 2]]
    rows += [[400 + i, list(rows[2][1]), 1] for i in range(120)]  # copies
    return [tuple(r) for r in rows]


@pytest.mark.parametrize("scale", [1.0, 2e5])  # the latter beyond exact products of floats
@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_equal_brute_force(spark, small, scale):
    rows = made_vectors(5, scale=scale)
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows], VECTORS).repartition(5)
    s = hard_negatives.Mining(block_bytes=100, anchors_at_once=1, rows_at_once=7) if small else hard_negatives.Mining()
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, s)
    got = Counter(tuple(r) for r in found.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got == brute_negatives(rows) and len(got) > 20


def test_packed_keys_sort_by_descending_score():
    keys = [(a, s, k, i) for a in (0, 1, 2**40) for s in (-2**63 + 1, -5, 0, 7, 2**63 - 1) for k in (0, 1) for i in (-9, 0, 2**62)]
    assert [hard_negatives.unpack(k) for k in sorted(hard_negatives.pack(*x) for x in keys)] == sorted(
        keys, key=lambda x: (x[0], -x[1], x[2], x[3]))


def test_windows_open_and_close():
    pack = hard_negatives.pack
    keys = sorted([pack(0, 100, 0, 1), pack(0, 50, 0, 2), pack(0, 91, 1, 3), pack(0, 90, 1, 4), pack(0, 45, 1, 5),
                   pack(0, 29, 1, 6), pack(0, 14, 1, 7), pack(1, 0, 0, 9), pack(1, 0, 1, 8), pack(1, -3, 1, 7)])
    rows = list(hard_negatives.mined(iter(keys), np.array([10, 20]), hard_negatives.Mining()))
    assert rows == [(10, 1, 1, 4, 100, 90), (10, 1, 2, 5, 100, 45), (10, 2, 1, 5, 50, 45), (10, 2, 2, 6, 50, 29),
                    (20, 9, 1, 8, 0, 0)]


def test_hard_negatives_of_empty_tables(spark):
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.digest(none).count() == 0
    alone = spark.createDataFrame([(100, [1.0], 1, 1.0, "x")], VECTORS)
    assert hard_negatives.digest(alone).count() == 0


# ---------------------------------------------------------------- lexical search


def brute_ranking(docs, items, k=50):
    bags = [(i, Counter(lowered_terms(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    out = set()
    for item_id, text in set(items):
        scored = []
        for (doc, bag), n in zip(bags, sizes):
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1000000000 * bag[t] // (1000 * bag[t] + 20 * (50 + 50 * n * n_docs // total)))
                for t in set(lowered_terms(text)) if bag[t]
            )
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        out |= {(item_id, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(scored)[:k], start=1)}
    return out


@pytest.mark.parametrize(
    "p", [lexical_search.Lexical(), lexical_search.Lexical(k=3, block_docs=4, block_postings=40, batch_terms=9, buffer_postings=60)]
)
def test_lexical_search_equals_brute_force(spark, p):
    rng = random.Random(8)
    texts = made_texts(8, 150) + ["w1 " * 5000, "w2 w3", "w2 w3", "w2 w3"] + ["same words here"] * 90
    docs = [(None if i == 9 else i % 170, t) for i, t in enumerate(texts)]
    items = [(i, " ".join(rng.choices(WORDS, k=rng.choice([1, 4, 20])))) for i in range(12)]
    items += [(3, "w2 w3"), (3, "w2 w3"), (20, "nowhere"), (21, None), (22, ""), (None, "same W1"), (23, "Same same words")]
    frame = spark.createDataFrame([(i, t, *EXTRA) for i, t in docs], DOCS).repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    got = lexical_search.ranked(frame, asked, p).collect()
    assert {tuple(r) for r in got} == brute_ranking(docs, items, p.k)
    per_item = defaultdict(int)
    for r in got:
        per_item[r.item_id] += 1
    assert per_item[20] == per_item[21] == 0


def test_bounds_prune_blocks(spark):
    """Blocks that cannot reach the k-th score are not visited, and no result is lost by that."""
    texts = ["common " * 3 + f"filler{i % 40} " * 20 for i in range(400)] + ["common rare"] * 6
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = spark.createDataFrame([(1, "common rare")], "item_id long, text string")
    p = lexical_search.Lexical(k=5, block_docs=50)
    items = next(lexical_search._batches(lexical_search._item_terms(asked, "item_id", "text"), p))
    known = spark.sparkContext.broadcast(items.vocabulary)
    seen = lexical_search._occurrences(docs, known, "doc_id", "text").cache()
    df = lexical_search._frequencies(seen, 2)
    items.weights = np.array([lexical_search.weight(406, int(d)) for d in df])[items.at]
    length = sum(len(lowered_terms(t)) for t in texts)
    index = lexical_search.build_index(seen, 406, length, p).cache()
    floors = lexical_search._floors(index, spark.sparkContext.broadcast(items), p)
    bounds = [lexical_search.bounds(r.asDict(), items)[0] for r in index.collect()]
    assert floors[0] > 0 and len(bounds) > 5 and sum(b >= floors[0] for b in bounds) == 1
    got = {tuple(r) for r in lexical_search.ranked(docs, asked, p).collect()}
    assert got == brute_ranking(list(enumerate(texts)), [(1, "common rare")], 5)


def test_lexical_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.ranked(docs.limit(0), items).count() == 0
    assert lexical_search.ranked(docs, items.limit(0)).count() == 0
    # One document, one term: ln(4/3) > 0.
    assert [r.score for r in lexical_search.ranked(docs, items).collect()] == [
        math.floor(1000 * math.log(4 / 3)) * (1000000000 // 3000)]
