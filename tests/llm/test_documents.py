"""Operators on documents against plain Python, on hand-made and on given rows."""

import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest

import corpus_pipeline
from gaugeframe.llm import language_id, mixing, near_dedup, packing, pii, quality
from gaugeframe.llm.common import stored

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, note string"
GOOD = " ".join(f"Word{i} and some more text here." for i in range(12))


def near(i):
    words = GOOD.split()
    words[i] = "changed"
    return " ".join(words)


TEXTS = [
    None, "", "   \n\t", "one", "one two three", GOOD, GOOD, GOOD.upper(), near(3), near(40),
    "a b c d e f g h " * 30, "menu | home | about | contact | help\n" + GOOD,
    "All rights reserved.\n" * 40, "buy $$$ now %%% ### " * 20, "WOW!! GREAT!! BUY!! NOW!! " * 20,
    "mail a.b@c.de.fg%d@e.f now, card 4111 1111-1111 1111 or 4111 1111 1111 1112 😀 ip 1.2.3.4.5.6.7.8 "
    "999.1.1.1 tel +49 (30) 123-456-78 and +1 23", "x" * 50_000, "9" * 50_000, "a." * 30_000,
    "word " * 20_000 + "end@mail.example.org", "é" * 30 + " naïve\x0bcafé\x0c" * 30,
]


@pytest.fixture(scope="module")
def docs(spark):
    """Null columns, repeated rows, long texts, and columns whose names operators use."""
    rows = [
        (None if i == 5 else i, t, None if i % 4 == 0 else "en", None if i % 3 == 0 else f"s{i % 5}", 1, -1, "x")
        for i, t in enumerate(TEXTS)
    ]
    return stored(spark.createDataFrame([*rows, rows[8], rows[8]], SCHEMA), "docs")


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("frame", ["docs", "given"])
def test_quality_counts(frame, request):
    df = request.getfixturevalue(frame)
    got = sorted(
        (str(r[0]), *r[1:6], r.base_failed) for r in quality.digest(df).collect()
    )
    assert got == sorted((str(d), *brute.quality_counts(t)) for d, t in pairs(df))


def test_quality_verdicts(docs):
    kept = {r.doc_id: r.kept for r in quality.digest(docs).collect()}
    assert kept[8] and kept[9] and kept[11]
    assert not any(kept[i] for i in (0, 1, 10, 12, 13, 14))
    out = quality.clean_lines(docs.where("doc_id = 11"), prefix="z_").first()
    assert out.z_clean_text == GOOD and out.note == "x" and out.n_words == -1


def test_pipeline_leaves_clean_prose_and_code_as_they_are(spark):
    prose = (
        "Bake each cookie for ten minutes.\nJavaScript runs in the browser.\n\n"
        "Copyright law protects authors of 1976 and later.\nMy aunt used to subscribe to two papers.\n"
        "Nobody should read more than this into it.\nThe song was licensed under odd terms.\n"
        "Cookies\nOh, the river runs.\nWe baked on and on.\nOh, the river runs.\n"
    )
    code = (
        "function total(list) {\n  let sum = 0;\n  for (const x of list) {\n    sum += x;\n  }\n"
        "  return sum;\n}\n\nfunction first(list) {\n  if (list.length) {\n    return list[0];\n  }\n"
        "  return null;\n}\n"
    )
    notices = (
        "Copyright (c) 2020 Somebody", "© 2021 A. Company. All rights reserved.", "Read more",
        "Privacy policy and terms of use", "Licensed under the Apache License, Version 2.0.",
        "This site uses cookies to improve your visit.", "Please enable JavaScript to go on.",
        "Subscribe to our weekly newsletter!", "Share this page",
    )
    rows = [(1, prose), (2, code), (3, "\n".join(notices) + "\n" + prose), (4, "\n".join(notices))]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.quality_rules(spark, df, "").collect()}
    assert got == {1: prose, 2: code, 3: prose}


@pytest.mark.parametrize("frame", ["docs", "given"])
def test_pii_base(frame, request):
    df = request.getfixturevalue(frame)
    want = sorted(
        (str(d), *map(len, brute.base_spans(t).values()), brute.base_hash(t)) for d, t in pairs(df)
    )
    rows = pii.digest(df).collect()
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows) == want
    text = dict(pairs(df))
    for r in rows:
        base = {f"{k}:{s}:{e}" for k, v in brute.base_spans(text[r.doc_id]).items() for s, e in v}
        assert base <= set(r.spans.split(","))


def test_pii_learns_and_redacts(spark):
    good = [(i, f"please call +1 ({100 + i}) 555-12{i:02d} today") for i in range(60)]
    odd = [(100, "please call 001 (555) 555-9999 today"), (101, None), (102, "mail x@y.zz, ok")]
    df = stored(spark.createDataFrame(good + odd, "doc_id long, text string"), "calls")
    model = pii.fit(df)
    assert model.thresholds["phone"] is not None
    out = {r.doc_id: r.text for r in pii.redact(df, model).collect()}
    assert out[3] == "please call [PHONE] today" and out[101] is None
    assert out[102] == "mail [EMAIL], ok"


def test_pii_tree_scores_agree(spark, given):
    """The trees as SQL give what they give in Python."""
    from gaugeframe.llm import boosting
    from pyspark.sql import functions as F

    rows = [dict(a=a, b=b, total=10, positive=10 * (a > 2) ^ (b > 1) * 3) for a in range(5) for b in range(4)]
    model = boosting.fit(rows, ("a", "b"))
    df = spark.createDataFrame([(r["a"], r["b"]) for r in rows], "a int, b int")
    got = df.select("a", "b", model.score_column({"a": F.col("a"), "b": F.col("b")}).alias("s")).collect()
    assert all(abs(r.s - model.score({"a": r.a, "b": r.b})) < 1e-12 for r in got)


def test_near_duplicates_given(given):
    want = brute.components(pairs(given))
    got = near_dedup.near_duplicates(given, near_dedup.NearDup(shingle=4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_odd_rows(docs):
    got = near_dedup.near_duplicates(docs, near_dedup.NearDup(shingle=4)).collect()
    assert len(got) == len(TEXTS) + 2
    want = brute.components([(d, t) for d, t in pairs(docs) if d is not None])
    for r in got:
        if r.doc_id is None:  # shares the set of document 6
            assert r.component_id == want[6][1] and not r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]


def test_near_duplicates_chains_in_blocks(spark):
    """Edits of edits: links that no star around one leader finds, over several small blocks."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(120)]
    rows, at = [], 0
    for _ in range(3):
        current = [f"{w}x{at}" for w in words]
        for _ in range(40):
            rows.append((at, " ".join(current)))
            at += 1
            current[rng.randrange(len(current))] = f"n{at}"
    df = stored(spark.createDataFrame(rows, "doc_id long, text string"), "chains")
    got = near_dedup.near_duplicates(df, near_dedup.NearDup(shingle=2, block=8)).collect()
    sets = {d: brute.shingles(t, 2) for d, t in rows}
    root = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and root[a] < root[b]:
                    root[b], changed = root[a], True
    assert {r.doc_id: r.component_id for r in got} == root


def test_near_duplicates_of_shared_and_missing_ids(spark):
    """Rows with one id and different texts, each near another row; rows without id in copies."""
    def text(stem, change=None):
        return " ".join(f"{stem}{'x' if i == change else i}" for i in range(80))

    rows = [(7, text("a")), (8, text("a", 40)), (7, text("b")), (9, text("b", 3)), (7, text("c"))]
    rows += [(None, text("d")), (None, text("d")), (None, text("a", 9)), (12, " "), (12, "")]
    df = stored(spark.createDataFrame(
        [(*r, "en") for r in rows], "doc_id long, text string, lang string"), "shared")
    got = near_dedup.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == sorted(
        [("7", "7")] * 3 + [("8", "7"), ("9", "7"), ("12", "12"), ("12", "12"), ("None", "7")]
        + [("None", "None")] * 2
    )
    kept = corpus_pipeline.near_duplicates(spark, df, "").collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept))) == sorted(
        map(str, [rows[0], rows[2], rows[4], rows[5], rows[8], rows[9]])
    )


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    for both, each in ((400, 50), (40, 30), (8, 1)):
        errors = []
        for _ in range(60):
            items = rng.integers(0, 2**63, both + 2 * each, dtype=np.uint64)
            a, b = items[: both + each], np.concatenate((items[:both], items[both + each :]))
            sig = near_dedup.signatures([a, b], 128)
            assert (sig >> np.uint64(32)).max() < 128
            errors.append(np.mean(sig[0] == sig[1]) - both / (both + 2 * each))
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_language(given, docs, spark):
    out = language_id.digest(given).collect()
    lang = {r.doc_id: r.lang for r in given.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in out)
    odd = {r.doc_id: r for r in language_id.digest(docs).collect()}
    assert odd[0].lang_pred == odd[1].lang_pred == odd[17].lang_pred == "und" and odd[6].lang_pred == "en"
    untrained = language_id.train(docs.where("lang = 'none'"))
    assert language_id.predict(docs, untrained).where("lang_pred != 'und'").isEmpty()


def test_language_counts_are_brute_force():
    text = "Añb " * 7
    counts = language_id.gram_counts(text, (1, 2, 3), 1 << 14)
    n = len(text) + 2
    assert counts.sum() == n + (n - 1) + (n - 2)
    one = language_id.gram_counts(text, (2,), 1 << 14)
    lowered = f" {text.lower()} "
    grams = [lowered[i : i + 2] for i in range(n - 1)]
    assert sorted(one[one > 0]) == sorted(grams.count(g) for g in set(grams))


@pytest.mark.parametrize("frame", ["docs", "given"])
def test_mixing(frame, request):
    df = request.getfixturevalue(frame)
    rows = mixing.mixed(df).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in df.collect():
        sizes[r.source] += len(brute.WORD.findall(r.text or ""))
    want = brute.targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r.size
        assert abs(r.target - float(want[r.source])) < 1e-6 * max(1, r.target)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - float(want[s])) <= 40 for s in want)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mixed(df).collect()))


def test_sainte_lague():
    rng = random.Random(1)
    for _ in range(30):
        parts = [rng.random() * 10 ** rng.randrange(4) for _ in range(rng.randrange(1, 9))]
        seats = rng.randrange(0, 60)
        quota = [0] * len(parts)
        for _ in range(seats):
            quota[max(range(len(parts)), key=lambda i: parts[i] / (2 * quota[i] + 1))] += 1
        assert mixing.sainte_lague(parts, seats, [10**6] * len(parts)) == quota
    assert mixing.sainte_lague([0.0], 3, [9]) == [0]


@pytest.mark.parametrize("frame", ["docs", "given"])
def test_packing(frame, request):
    df = request.getfixturevalue(frame)
    p = packing.Packing(capacity=512)
    rows = packing.pack(df, p).collect()
    total = sum(len(brute.WORD.findall(t or "")) for _, t in pairs(df))
    assert sum(r.n_words for r in rows) == total
    bins = defaultdict(list)
    for r in rows:
        assert (r.bin is None) == (r.n_words == 0)
        bins[r.bin].append((r.bin_offset, r.n_words, r.source))
    bins.pop(None, None)
    for items in bins.values():
        items.sort(key=lambda x: x[0])
        assert [x[0] for x in items] == [sum(y[1] for y in items[:i]) for i in range(len(items))]
        assert sum(x[1] for x in items) <= 512
        used = defaultdict(int)
        for _, n, s in sorted(items, key=lambda x: x[0]):
            assert used[s] < 256
            used[s] += n


def test_packing_keeps_copies_apart(docs):
    rows = packing.pack(docs.where("doc_id IN (8, 9)")).collect()
    assert len({r.bin for r in rows if r.doc_id == 8}) == 3


def test_large_ids_beside_nulls_are_not_rounded(spark):
    big = 2**60
    rows = [(big + i if i % 3 else None, f"some words of text {i}", "s") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    want = sorted(str(r[0]) for r in rows)
    assert sorted(str(r.doc_id) for r in packing.pack(df).collect()) == want
    features = near_dedup.features(df, near_dedup.NearDup())
    assert sorted(str(r.doc) for r in features.select("doc").collect()) == want


def test_best_fit_takes_the_tightest_compatible_bin():
    bins = packing.Bins(packing.Packing(capacity=10, source_share=0.8))
    assert bins.place(6, "a", 1) == (0, 0) and bins.place(7, "b", 2) == (1, 0)
    assert bins.place(3, "c", 2) == (0, 6)  # bin 1 is tighter but holds the cluster
    assert bins.place(3, "d", 3) == (1, 7)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.digest(empty).isEmpty() and pii.digest(empty).isEmpty()
    assert near_dedup.near_duplicates(empty).isEmpty() and language_id.digest(empty).isEmpty()
    assert mixing.mixed(empty).isEmpty() and packing.pack(empty).isEmpty()


def test_pipeline(docs, given):
    spark = docs.sparkSession
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = current
        current = stored(stage(spark, before, ""), name)
        assert current.columns == before.columns
        ids = {r.doc_id for r in current.select("doc_id").collect()}
        if name == "quality_rules":
            assert {8, 9, 11} <= ids and not ids & {0, 1, 10, 12, 13, 14}
        if name == "near_duplicates":
            assert current.where("doc_id = 8").count() + current.where("doc_id = 6").count() <= 2
            assert current.where("doc_id IS NOT NULL").count() == len(ids - {None})
        if name == "mix_sources":
            assert current.groupBy("doc_id").count().where("count > 4").isEmpty()
    assert not corpus_pipeline.run(spark, SF).isEmpty()


CLASHES = ("doc", "t1", "t2", "unnamed", "_base", "_seen", "_row", "row", "place", "q_kept", "_q_kept", "q_clean_text",
           "_pii_spans", "pii_spans", "_text", "order", "shard", "size", "taken", "_copy", "quota", "end", "cluster",
           "group", "n", "root", "component_id", "a.b")


def test_stages_keep_columns_of_any_name(spark):
    """Columns named as the stages' working columns pass through as they are."""
    texts = [GOOD, near(3), f"{near(40)} x@y.zz", " ".join(f"term{i}" for i in range(40)), None, ""]
    rows = [(i, t, "en", "s", 1, *[f"{c}{i}" for c in CLASHES]) for i, t in enumerate(texts)]
    rows.append((None, " ".join(f"other{i}" for i in range(40)), None, None, 1, *["z"] * len(CLASHES)))
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
    docs = stored(spark.createDataFrame(rows, schema), "clashes")
    given = {r["doc_id"]: tuple(r)[5:] for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, ""), name)
        assert docs.columns == [f.name for f in docs.schema] and len(docs.columns) == 5 + len(CLASHES)
        out = docs.collect()
        assert all(tuple(r)[5:] == given[r["doc_id"]] for r in out), name
        kept[name] = {r["doc_id"] for r in out}
    assert kept["quality_rules"] == {0, 1, 2, 3, None} and kept["near_duplicates"] == {0, 3, None}
    assert corpus_pipeline.pack_bins(spark, docs, "").count() > 0


def test_redaction_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "mail x@y.zz", "b", "s")], "doc_id long, text string, _base string, _seen string")
    out = pii.redact(df, pii.fit(df)).first()
    assert tuple(out) == (1, "mail [EMAIL]", "b", "s")


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), name)
        assert docs.count() == 0, name


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from gaugeframe.llm import common

    class Session:
        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.scratch_dir(Session)


def test_block_links_skip_what_is_joined():
    """Pairs that agree are intersected; groups joined by a link are not linked again."""
    rng = np.random.default_rng(3)
    base = np.sort(rng.integers(0, 2**62, 400, dtype=np.uint64))
    sets = [base, np.unique(np.append(base[5:], np.uint64(7))), base[10:], np.sort(rng.integers(0, 2**62, 400, dtype=np.uint64))]
    sig = near_dedup.signatures(sets, 128)
    band = [near_dedup._mix(s.reshape(32, 4).sum(axis=1, dtype=np.uint64)).view(np.int64) for s in sig]
    band = [np.concatenate(([1], b[1:])) for b in band]
    import pandas as pd

    rows = pd.DataFrame([
        {"key": 1, "i": 0, "j": 0, "side": side, "id": i, "n": len(sets[i]), "root": i, "bands": band[i],
         "sig": (sig[i] & np.uint64(255)).astype(np.uint8).tobytes(), "items": sets[i].tobytes()}
        for side in (0, 1) for i in range(4)
    ])
    out = pd.concat(list(near_dedup._block_links(iter([rows]), near_dedup.NearDup())))
    assert len(out) == 2 and set(out["a"]) | set(out["b"]) == {0, 1, 2}
