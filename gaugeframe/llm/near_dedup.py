"""Near-duplicate documents: SuperMinHash signatures, banding, verification, union-find.

1. Every text becomes a set of hashed word shingles. Equal sets are one node, whose id is a hash
   of the set, so that rows which share a document id or have none are nodes by their texts.
   Only the result names components, by their smallest document id; nothing later grows with the number of exact copies.
2. SuperMinHash: each shingle ranks the signature's slots by a permutation of its own, and the
   j-th ranked slot is offered j plus a random fraction. A slot keeps its smallest offer, and
   ranks stop once no later one could win. The permutation is a keyed mixing of j, so numpy
   computes a rank for all shingles of a batch at once. Two signatures agree in a slot with
   the probability of the sets' Jaccard similarity.
3. Banding: documents meet where all rows of a band agree. With 32 bands of 4 rows a pair at
   the threshold of 0.8 is missed with a probability of about 5e-8, any closer pair less.
4. Verification: a bucket's leader is the node that meets most others over all its bands, as
   the original of a group of edited copies does. Every node is held against its best leader.
   Linked nodes are grouped; buckets whose nodes are all in one group need no more. In the
   others, every node outside the leader's group is held against all nodes of other groups, in
   blocks of bounded size. A pair is looked at in the first band it shares only. Signatures tell
   which nodes need their full sets read, and which pairs of them are compared; only full sets
   confirm a link. A block skips pairs whose groups it has joined already and gives no more
   links than connect its groups, so no pairs of a group are listed.
5. Union-find over the links: hooking to the smallest neighbour and pointer jumping, as joins.

Hot buckets and groups: minima and counts are combined before each shuffle, and joins on them
are between stored tables, which the adaptive skew join may split.

Defined results: words are lower-cased in A-Z only. Texts without words (or null) have an empty
set, form no link and are their own component. Fewer words than a shingle's length: the whole
sequence is one shingle. Rows that share a doc_id are told apart by their texts. A row without
doc_id takes the component of an equal set, else null, and links nothing. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm.common import stored
from gaugeframe.llm.terms import NOT_SPACE, terms_of

_U = np.uint64
# Elements handled at a time; bounds the memory of a batch of any size.
_CHUNK = 1 << 18
# Size of the bitmap of wanted texts: 2^19 words of 64 bits at most.
_END_BITS = 25
# Texts whose signatures a task remembers; some 400 bytes each.
_REMEMBERED = 1 << 13


@dataclass(frozen=True)
class NearDup:
    """`shingle` words per shingle; pairs link from `percent` similarity on."""

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    # Pairs whose signatures agree in a smaller share are not read in full. At 128 slots this
    # is over seven standard deviations below the similarity of any pair that links.
    least_agreement: float = 0.55
    # Nodes of one bucket that meet in one task, on either side.
    block: int = 512

    @property
    def slots(self) -> int:
        return self.bands * self.rows


# ---------------------------------------------------------------- sets and signatures


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> _U(32))) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _rolled(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every `length` consecutive words."""
    n = max(0, len(words) - length + 1)
    out = np.full(n, length, _U)
    for i in range(length):
        out = _mix(out ^ words[i : n + i]) + _U(i)
    return out


def shingle_sets(texts: list[str | None], length: int) -> list[np.ndarray]:
    """The distinct 64-bit shingle hashes of each text, sorted."""
    out = []
    for t in terms_of(pa.array(texts, pa.large_string()), NOT_SPACE):
        shingles = _rolled(t.hashes, length)
        for a, b in zip(t.first[:-1].tolist(), t.first[1:].tolist()):
            if b - a >= length:
                own = np.sort(shingles[a : b - length + 1])
                out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
            else:  # the whole sequence is one shingle
                out.append(_rolled(t.hashes[a:b], b - a) if b > a else np.empty(0, _U))
    return out


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash of non-empty sets: per set and slot, rank in the high and a random
    fraction in the low 32 bits. `slots` is a power of two."""
    sizes = np.array([len(s) for s in sets])
    out = np.full((len(sets), slots), np.iinfo(_U).max, _U)
    first = 0
    while first < len(sets):  # whole sets, about _CHUNK elements at a time
        last = first + 1
        total = sizes[first]
        while last < len(sets) and total + sizes[last] <= _CHUNK:
            total += sizes[last]
            last += 1
        for start in range(0, total, _CHUNK):  # a huge set goes in pieces
            values = np.concatenate(sets[first:last])[start : start + _CHUNK]
            owner = np.repeat(np.arange(last - first), sizes[first:last])[start : start + _CHUNK]
            _offer(out[first:last], values, owner, slots)
        first = last
    return out


def _offer(out: np.ndarray, values: np.ndarray, owner: np.ndarray, slots: int) -> None:
    bits, mask = _U(slots.bit_length() - 1), _U(slots - 1)
    keys = [_mix(values + _U(k)) for k in (0x5151, 0xA3A3)]
    flat = out.reshape(-1)
    for rank in range(slots):
        # The keyed permutation of slots: odd multiples, sums and shifts are all bijective.
        x = np.full(len(values), rank, _U)
        for step in range(3):
            k = keys[0] >> _U(21 * step)
            x = (x * (k | _U(1)) + (k >> bits)) & mask
            x ^= x >> _U(3 if step % 2 else 4)
        x = (x + keys[1]) & mask
        offer = (_U(rank) << _U(32)) | (_mix(keys[1] + _U(rank)) >> _U(32))
        np.minimum.at(flat, owner * slots + x.astype(np.int64), offer)
        # Later ranks offer at least rank + 1: sets whose slots all hold less are done.
        open_ = (out.max(axis=1) >> _U(32)) > _U(rank)
        if not open_.any():
            return
        if not open_.all():
            rest = open_[owner]
            values, owner = values[rest], owner[rest]
            keys = [k[rest] for k in keys]


def _described(texts: list[str], p: NearDup) -> list[tuple]:
    """(size, hash, hash, bands, signature bytes) of each text's set; the last two null if empty."""
    sets = shingle_sets(texts, p.shingle)
    full = [i for i, s in enumerate(sets) if len(s)]
    sig = signatures([sets[i] for i in full], p.slots) if full else np.empty((0, p.slots), _U)
    band = np.zeros((len(full), p.bands), _U) + np.arange(p.bands, dtype=_U)
    for r in range(p.rows):
        band = _mix(band ^ sig.reshape(-1, p.bands, p.rows)[:, :, r]) + _U(r)
    at = dict(zip(full, range(len(full))))
    out = []
    for i, s in enumerate(sets):
        with np.errstate(over="ignore"):
            h1 = int(_mix(s).sum(dtype=_U).view(np.int64))
            h2 = int(np.bitwise_xor.reduce(_mix(s + _U(7)), initial=_U(0)).view(np.int64))
        rest = (None, None)
        if i in at:
            rest = band[at[i]].view(np.int64), (sig[at[i]] & _U(255)).astype(np.uint8).tobytes()
        out.append((len(s), h1, h2, *rest))
    return out


def _features(batches: Iterator[pd.DataFrame], p: NearDup) -> Iterator[pd.DataFrame]:
    # Copies that a task meets are signed once, as long as it remembers their text keys.
    known: dict[tuple[int, int], tuple] = {}
    for pdf in batches:
        for start in range(0, len(pdf), 512):
            part = pdf.iloc[start : start + 512]
            keys = list(zip(part["t1"].tolist(), part["t2"].tolist()))
            fresh = {k: t for k, t in zip(keys, part["text"]) if k not in known}
            made = known | dict(zip(fresh, _described(list(fresh.values()), p)))
            columns = list(zip(*[made[k] for k in keys]))
            known = made if len(made) < _REMEMBERED else {}
            yield pd.DataFrame(
                {"doc": part["doc"].array, "t1": part["t1"].array, "t2": part["t2"].array}
                | dict(zip(("n", "h1", "h2", "bands", "sig"), map(list, columns)))
            )


def text_keys(text: str) -> list[F.Column]:
    """`t1`, `t2`: a 128-bit hash of the text."""
    body = F.col(text).cast("string")
    return [F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(1), body).alias("t2")]


def features(docs: DataFrame, p: NearDup, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id `doc`, text keys, set size `n`, a 128-bit hash of the set, band keys and
    signature bytes."""
    return docs.select(
        F.col(doc_id).cast("long").cast("string").alias("doc"), *text_keys(text),
        F.col(text).cast("string").alias("text"),
    ).mapInPandas(  # ids as text: beside nulls pandas would round large numbers
        lambda batches: _features(batches, p),
        "doc string, t1 long, t2 long, n long, h1 long, h2 long, bands array<long>, sig binary",
    ).withColumn("doc", F.col("doc").cast("long"))


# ---------------------------------------------------------------- verification


def _agree(a: pd.Series, b: pd.Series) -> pd.Series:
    rows = zip(a, b)
    return pd.Series(
        [float(np.mean(np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8))) for x, y in rows]
    )


def _shared(a: pd.Series, b: pd.Series) -> pd.Series:
    """Sizes of intersections of sorted hash sets."""
    return pd.Series(
        [
            len(np.intersect1d(np.frombuffer(x, _U), np.frombuffer(y, _U), assume_unique=True))
            for x, y in zip(a, b)
        ],
        dtype="int64",
    )


def _sets(docs: DataFrame, places: DataFrame, ids: DataFrame, p: NearDup) -> DataFrame:
    """Full sets (id, n, items) of the nodes in `ids`, from their whole texts.

    `docs` has texts with their ends (place, t1, t2), and `places` the ends of every node. A
    broadcast bitmap of the wanted ends keeps other texts, but for chance hits, from moving; it
    has at most 2^(_END_BITS - 6) rows. What it lets through is joined exactly.
    """

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), 512):
                part = pdf.iloc[start : start + 512]
                sets = shingle_sets(part["text"].tolist(), p.shingle)
                yield pd.DataFrame(
                    {"id": part["id"].array, "n": [len(s) for s in sets],
                     "items": [s.tobytes() for s in sets]}
                )

    ends = ["place", "t1", "t2"]
    spot = F.xxhash64(*ends).bitwiseAND(F.lit((1 << _END_BITS) - 1))
    word, bit = F.shiftright(spot, 6).alias("word"), spot.bitwiseAND(F.lit(63)).cast("int").alias("bit")
    wanted = stored(places.join(ids, "id", "left_semi"), "wanted")
    bitmap = wanted.select(word, bit).groupBy("word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")
    )
    return (
        docs.select("*", word, bit).join(F.broadcast(bitmap), "word")
        .where("(shiftrightunsigned(bits, bit) & 1) = 1")
        .join(wanted, ends).dropDuplicates(ends).select("id", "text")
        .mapInPandas(build, "id long, n long, items binary")
    )


def _similar(n_a: str, n_b: str, both, p: NearDup):
    return both * (100 + p.percent) >= (F.col(n_a) + F.col(n_b)) * p.percent


def verified(
    pairs: DataFrame, nodes: DataFrame, docs: DataFrame, places: DataFrame, p: NearDup
) -> DataFrame:
    """Those pairs (a, b) of nodes that are similar; `docs` and `places` as for `_sets`."""
    agree = F.pandas_udf(_agree, "double")
    shared = F.pandas_udf(_shared, "long")

    def side(frame: DataFrame, end: str, *columns: str) -> DataFrame:
        return frame.select(F.col("id").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])

    likely = stored(
        pairs.join(side(nodes, "a", "sig"), "a")
        .join(side(nodes, "b", "sig"), "b")
        .where(agree("sig_a", "sig_b") >= p.least_agreement)
        .select("a", "b"),
        "likely",
    )
    ids = likely.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = stored(_sets(docs, places, ids, p), "sets")
    return (
        likely.join(side(sets, "a", "n", "items"), "a")
        .join(side(sets, "b", "n", "items"), "b")
        .withColumn("both", shared("items_a", "items_b"))
        .where(_similar("n_a", "n_b", F.col("both"), p))
        .select("a", "b")
    )


# ---------------------------------------------------------------- blocks of open buckets


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The groups of a stream that is sorted by `keys`, as arrays by column."""
    held: pd.DataFrame | None = None
    for pdf in batches:
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        values = pdf[keys].to_numpy()
        ends = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        columns = {c: pdf[c].to_numpy() for c in pdf.columns}
        for start, end in zip(np.concatenate(([0], ends[:-1])), ends):
            yield {c: v[start:end] for c, v in columns.items()}
        held = pdf.iloc[ends[-1] if len(ends) else 0 :]
    if held is not None and len(held):
        yield {c: held[c].to_numpy() for c in held.columns}


def _blocked(rows: DataFrame, payload: DataFrame, p: NearDup) -> DataFrame:
    """Rows of open buckets (key, id, n, root, main) with the nodes' payload, dealt to blocks.

    Nodes outside the leader's group (side 0) meet all nodes of their bucket (side 1). Both
    sides are cut by hash; a row goes to as many blocks as the other side has.
    """
    outside = F.col("root") != F.col("main")
    counts = stored(
        rows.groupBy("key").agg(
            F.ceil(F.sum(outside.cast("long")) / p.block).alias("i_blocks"),
            F.ceil(F.count("*") / p.block).alias("j_blocks"),
        ).where("i_blocks > 0"),
        "blocks",
    )
    dealt = rows.join(counts, "key").withColumns(
        {
            "i": F.pmod(F.xxhash64("id"), F.col("i_blocks")),
            "j": F.pmod(F.xxhash64("id"), F.col("j_blocks")),
        }
    )

    def all_of(n: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    ends = ("i_blocks", "j_blocks")
    left = dealt.where(outside).withColumn("j", all_of("j_blocks")).withColumn("side", F.lit(0))
    right = dealt.withColumn("i", all_of("i_blocks")).withColumn("side", F.lit(1))
    return (
        left.drop(*ends).unionByName(right.drop(*ends)).join(payload, "id")
        .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "id")
    )


def _open_pairs(run: dict[str, np.ndarray], p: NearDup) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs of one block: other groups, fitting sizes, first shared band."""
    left, right = np.flatnonzero(run["side"] == 0), np.flatnonzero(run["side"] == 1)
    if not len(left) or not len(right):
        return left[:0], right[:0]
    root, n = run["root"], run["n"]
    bands = np.stack([np.asarray(b, np.int64) for b in run["bands"]])
    here = int(np.flatnonzero(bands[0] == run["key"][0])[0])
    fits = root[left][:, None] != root[right][None, :]
    small = np.minimum(n[left][:, None], n[right][None, :])
    fits &= small * 100 >= np.maximum(n[left][:, None], n[right][None, :]) * p.percent
    for band in range(here):
        fits &= bands[left, band][:, None] != bands[right, band][None, :]
    x, y = np.nonzero(fits)
    return left[x], right[y]


def _likely_nodes(batches: Iterator[pd.DataFrame], p: NearDup) -> Iterator[pd.DataFrame]:
    """(key, id) of nodes with a pair whose signatures agree enough."""
    for run in _runs(batches, ["key", "i", "j"]):
        x, y = _open_pairs(run, p)
        if not len(x):
            continue
        near = _agreeing(run, x, y, p)
        likely = np.zeros(len(run["id"]), bool)
        likely[x[near]] = likely[y[near]] = True
        ids = np.unique(run["id"][likely])
        if len(ids):
            yield pd.DataFrame({"key": run["key"][0], "id": ids})


def _agreeing(run: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, p: NearDup) -> np.ndarray:
    """Which of the pairs agree in enough signature slots."""
    sig = np.stack([np.frombuffer(v, np.uint8) for v in run["sig"]])
    out = np.zeros(len(x), bool)
    for start in range(0, len(x), 1 << 14):
        part = slice(start, start + (1 << 14))
        out[part] = (sig[x[part]] == sig[y[part]]).mean(axis=1) >= p.least_agreement
    return out


def _shared_with(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted set with others, none empty."""
    values = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, values), len(one) - 1)
    starts = np.cumsum([0, *[len(s) for s in others[:-1]]])
    return np.add.reduceat((one[at] == values).astype(np.int64), starts)


def _block_links(batches: Iterator[pd.DataFrame], p: NearDup) -> Iterator[pd.DataFrame]:
    """Links (a, b) that connect the groups of each block, from full sets.

    Only pairs whose signatures agree are intersected, and none whose groups this block has
    joined by then: a further link between them would connect nothing.
    """
    for run in _runs(batches, ["key", "i", "j"]):
        x, y = _open_pairs(run, p)
        near = _agreeing(run, x, y, p) if len(x) else np.zeros(0, bool)
        x, y = x[near], y[near]
        if not len(x):
            continue
        n, ids, root = run["n"], run["id"], run["root"]
        top: dict[int, int] = {}

        def find(r: int) -> int:
            while r in top:
                r = top[r]
            return r

        links = []
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        ends = np.append(np.flatnonzero(np.diff(x)) + 1, len(x))
        for first, last in zip(np.concatenate(([0], ends[:-1])), ends):
            a = x[first]
            own = np.frombuffer(run["items"][a], _U)
            rest = y[first:last]
            for start in range(0, len(rest), 32):
                mine = find(int(root[a]))
                part = [b for b in rest[start : start + 32] if find(int(root[b])) != mine]
                if not part:
                    continue
                both = _shared_with(own, [np.frombuffer(run["items"][b], _U) for b in part])
                for b, shared in zip(part, both):
                    if shared * (100 + p.percent) >= (n[a] + n[b]) * p.percent:
                        ra, rb = find(int(root[a])), find(int(root[b]))
                        if ra != rb:
                            top[max(ra, rb)] = min(ra, rb)
                            links.append((int(ids[a]), int(ids[b])))
        if links:
            yield pd.DataFrame(links, columns=["a", "b"])


def across_groups(
    rows: DataFrame, nodes: DataFrame, docs: DataFrame, places: DataFrame, p: NearDup
) -> DataFrame:
    """Links (a, b) between groups within open buckets (key, id, n, root, main)."""
    shape = nodes.select("id", "bands", "sig")
    likely = stored(
        _blocked(rows, shape, p)
        .mapInPandas(lambda batches: _likely_nodes(batches, p), "key long, id long").distinct(),
        "likely",
    )
    sets = stored(_sets(docs, places, likely.select("id").distinct(), p), "sets")
    narrowed = stored(rows.join(likely, ["key", "id"], "left_semi"), "narrowed")
    held = shape.join(sets.select("id", "items"), "id")
    return _blocked(narrowed, held, p).mapInPandas(
        lambda batches: _block_links(batches, p), "a long, b long"
    )


# ---------------------------------------------------------------- union-find


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every end of the links (a, b): root is the smallest id it reaches.

    Each round hooks every node to its smallest neighbour, flattens the trees by pointer
    jumping and keeps the links between different trees. Rounds are logarithmic in practice.
    """
    links = stored(links.where("a != b"), "links")
    labels = None
    while True:
        both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
        parent = stored(
            both.groupBy(F.col("a").alias("id"))
            .agg(F.least(F.min("b"), F.col("id")).alias("root")),
            "hooks",
        )
        while True:
            up = parent.select(F.col("id").alias("root"), F.col("root").alias("next"))
            jumped = stored(
                parent.join(up, "root", "left")
                .select("id", F.coalesce("next", "root").alias("root"),
                        (F.col("next") != F.col("root")).alias("moved")),
                "jumped",
            )
            parent = jumped.select("id", "root")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = parent
        else:
            up = parent.select(F.col("id").alias("root"), F.col("root").alias("next"))
            labels = stored(
                labels.join(up, "root", "left").select("id", F.coalesce("next", "root").alias("root")),
                "labels",
            )
        ends = [parent.select(F.col("id").alias(e), F.col("root").alias(f"r{e}")) for e in ("a", "b")]
        links = stored(
            links.join(ends[0], "a").join(ends[1], "b").where("ra != rb")
            .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(),
            "contracted",
        )
        if links.isEmpty():
            return labels


# ---------------------------------------------------------------- the operator


def grouped_rows(
    docs: DataFrame, p: NearDup = NearDup(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc, t1, t2, n, root, component_id) for every row of `docs`.

    `root` tells the components apart, and is null for texts without words; `component_id` is
    the smallest document id in it, or null.
    """
    rows = stored(features(docs, p, doc_id, text), "features")
    # A row of each set stands for its node; which one of equal texts does not matter.
    place = F.coalesce("doc", F.lit(0).cast("long")).alias("place")
    copies = stored(
        rows.where("n > 0").groupBy("h1", "h2", "n")
        .agg(F.min("doc").alias("doc"), F.min(F.struct(place, "t1", "t2")).alias("row"))
        .select("h1", "h2", "n", "doc", "row.place", "row.t1", "row.t2",
                F.shiftrightunsigned(F.xxhash64("h1", "h2", "n"), 1).alias("id")),
        "copies",
    )
    ends = ["place", "t1", "t2"]
    nodes = stored(
        rows.where("n > 0").select("*", place)
        .join(copies.drop("doc"), ["h1", "h2", "n", *ends])
        .select("id", "n", "bands", "sig").dropDuplicates(["id"]),
        "nodes",
    )
    keyed = nodes.select(F.explode("bands").alias("key"), "id", "n")
    met = stored(
        keyed.groupBy("key").agg(F.count("*").alias("met"), F.min("id").alias("x"), F.max("id").alias("y"))
        .where("x != y").select("key", "met"),
        "buckets",
    )
    members = stored(keyed.join(met, "key"), "members")
    central = stored(members.groupBy("id").agg(F.sum("met").alias("weight")), "central")
    best = F.max(F.struct("weight", (-F.col("id")).alias("id"), "n"))
    leaders = stored(
        members.join(central, "id").groupBy("key").agg(best.alias("best"))
        .select("key", F.col("best.weight").alias("weight"), (-F.col("best.id")).alias("leader"),
                F.col("best.n").alias("leader_n")),
        "leaders",
    )

    def sizes_fit(x: str, y: str) -> F.Column:
        return (F.col(x) * 100 >= F.col(y) * p.percent) & (F.col(y) * 100 >= F.col(x) * p.percent)

    stars = (
        members.join(leaders, "key").where((F.col("leader") != F.col("id")) & sizes_fit("n", "leader_n"))
        .groupBy(F.col("id").alias("b"))
        .agg(F.max(F.struct("weight", (-F.col("leader")).alias("leader"))).alias("best"))
        .select((-F.col("best.leader")).alias("a"), "b")
    )
    texts = docs.select(
        F.col(doc_id).cast("long").alias("doc"), *text_keys(text), F.col(text).cast("string").alias("text")
    ).select("t1", "t2", "text", place)
    places = copies.select("id", *ends)
    links = stored(verified(stored(stars, "stars"), nodes, texts, places, p), "links")
    labels = components(links)

    def grouped(frame: DataFrame, column: str, name: str) -> DataFrame:
        found = labels.select(F.col("id").alias(column), F.col("root").alias(name))
        return frame.join(found, column, "left").withColumn(name, F.coalesce(name, column))

    mains = stored(grouped(leaders, "leader", "main").select("key", "main"), "mains")
    placed = stored(
        grouped(members.select("key", "id", "n"), "id", "root").join(mains, "key"), "placed"
    )
    mixed = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    mixed = stored(mixed.where("x != y").select("key"), "mixed")
    open_ = stored(placed.join(mixed, "key", "left_semi"), "open")
    more = stored(across_groups(open_, nodes, texts, places, p), "links")
    if not more.isEmpty():
        labels = components(links.union(more))

    component = stored(
        copies.join(labels, "id", "left")
        .select("h1", "h2", "n", "doc", F.coalesce("root", "id").alias("root")),
        "components",
    )
    names = stored(component.groupBy("root").agg(F.min("doc").alias("component_id")), "names")
    named = stored(component.drop("doc").join(names, "root"), "named")
    return rows.select("doc", "t1", "t2", "n", "h1", "h2").join(
        named, ["h1", "h2", "n"], "left"
    ).select(
        "doc", "t1", "t2", "n", "root",
        F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component_id")).alias("component_id"),
    )


def near_duplicates(
    docs: DataFrame, p: NearDup = NearDup(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs`."""
    return grouped_rows(docs, p, doc_id, text).select(
        F.col("doc").alias(doc_id), F.col("n").alias("n_shingles"), "component_id",
    ).withColumn("kept", F.col(doc_id).eqNullSafe(F.col("component_id")))
