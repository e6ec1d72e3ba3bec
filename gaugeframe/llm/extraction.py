"""Main text of pages by wrapper induction.

A host's pages of one layout (the same nesting of structural elements) are induced together.
Per layout, one page is the reference: the smallest id hash of those with text. Every page's
tree of blocks is aligned with it by simple tree matching, and each text of the reference gets
the votes of all pages: text that is equal on almost all of them is constant, which makes it
template. Template texts of layouts with many votes hold for the whole host. Extraction takes
all texts of a page but the template's, in page order, so that nothing which varies is left
out, wherever it stands.

Elements whose tag, role or class says that they are no article (menus, headers, footers,
sidebars, notices, adverts, forms, comments) never enter the trees, so that varying adverts and
menus do not pass for content. Pages that hold mostly the reference's own text are copies and
vote on nothing: what they share is content, not template.

Skew: votes are sums per layout and text, combined before the shuffle. Pages meet the layout's
reference and wrapper by joins on stored tables, which the adaptive skew join may split. A
layout's votes are as many as its reference has texts.

Defined results: a null html is an empty page and gives an empty text. A null or malformed url
belongs to the empty host. Where too few pages vote to tell template from content, and on pages
of template texts alone, the texts are those of the page's own article and main elements and its
h1, or all if it has none of these. Rows that share a page_id are pages of their own. Other
columns play no part.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm.common import stored
from gaugeframe.llm.dom import INLINE, RAW, Node, blocks, parse

NOISE_TAGS = frozenset("head nav footer aside form button select dialog menu".split())
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert form menu".split()
)
# The first part of a class or id, up to a hyphen, underscore or capital letter.
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright disqus footer gdpr menu modal nav navbar navigation "
    "newsletter notice notices notification overlay pager pagination popup promo promotion "
    "recommended related replies reply share sharing sidebar signup skip social sponsor sponsored "
    "subscribe toolbar widget".split()
)
_NAME = re.compile(r"[A-Z]?[a-z]+|[0-9]+")
# Elements that make up a layout, down to a depth below the root; others come with the content.
_STRUCTURE = frozenset("html body main article section div header center table tbody tr td".split())
_LAYOUT_DEPTH = 4


@dataclass(frozen=True)
class Wrapper:
    """Thresholds of the induction."""

    # A constant text is template if so many pages agree, and at least this share of all. Where
    # fewer pages vote, all of them have to agree, and at least `least_votes`. Template texts
    # hold for other layouts of the host from `min_votes` on.
    min_votes: int = 4
    least_votes: int = 2
    constant_share: float = 0.8
    # Pages that repeat more than this share of the reference's text are copies of it.
    copy_share: float = 0.5


def is_noise(node: Node, path: tuple[str, ...]) -> bool:
    if node.tag in NOISE_TAGS:
        return True
    if node.tag == "header":  # a site's header, or an article's own with its title
        return "article" not in path and "main" not in path
    if not node.attrs:
        return False
    attrs = node.attributes()
    if "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    if attrs.get("role", "").lower() in NOISE_ROLES:
        return True
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        first = _NAME.match(name)
        if first and first[0].lower() in NOISE_NAMES:
            return True
    return False


# ---------------------------------------------------------------- trees of blocks


def compact(root: Node) -> list:
    """[tag, characters, texts, children] of block elements, noise left out.

    Neighbouring leaves of one tag are one node, as their number says nothing of the template;
    it holds the (hash, characters) of all their texts.
    """

    def build(node: Node, path: tuple[str, ...]) -> list:
        own, kids = [], []
        todo = list(reversed(node.kids))
        while todo:
            kid = todo.pop()
            if isinstance(kid, str):
                own.append(kid)
            elif kid.tag in RAW or is_noise(kid, path):
                continue
            elif kid.tag in INLINE:
                todo.extend(reversed(kid.kids))
            elif len(path) >= 64:  # deeper nesting counts as text of this node
                own.extend(text for _, text in blocks(kid, is_noise, path))
            else:
                kids.append(build(kid, path + (kid.tag,)))
        text = " ".join("".join(own).split())
        merged: list[list] = []
        for kid in kids:
            if merged and kid[0] == merged[-1][0] and not kid[3] and not merged[-1][3]:
                merged[-1][1] += kid[1]
                merged[-1][2] += kid[2]
            else:
                merged.append(kid)
        return [node.tag, len(text), [[_hash(text), len(text)]] if text else [], merged]

    return build(root, ())


def _hash(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def layout(tree: list) -> str:
    """A hash of the paths of structural elements with text, whatever their number and order."""
    paths = set()

    def walk(node: list, path: tuple[str, ...]) -> bool:
        held = [walk(kid, path + (kid[0],)) for kid in node[3]]
        text = bool(node[1]) or any(held)
        if text and len(path) <= _LAYOUT_DEPTH and _STRUCTURE.issuperset(path):
            paths.add("/".join(path))
        return text

    walk(tree, ())
    return _hash(" ".join(sorted(paths)))


def numbered(tree: list) -> list[list]:
    """The nodes in page order; a node's number is its place."""
    out, todo = [], [tree]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(reversed(node[3]))
    return out


def match(a: list, b: list) -> tuple[int, list[tuple[list, list]]]:
    """Simple tree matching: the most nodes that two trees share in order, and the pairs."""
    if a[0] != b[0]:
        return 0, []
    x, y = a[3], b[3]
    found = {}
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, p in enumerate(x):
        for j, q in enumerate(y):
            both = 0
            if p[0] == q[0]:
                found[i, j] = match(p, q)
                both = found[i, j][0]
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + both)
    pairs, i, j = [(a, b)], len(x), len(y)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs += found[i, j][1]
    return best[-1][-1] + 1, pairs


def _places(reference: list) -> dict[int, int]:
    """Each node's number by identity; the numbers after it are those of its texts."""
    places, at = {}, 0
    for node in numbered(reference):
        places[id(node)] = at
        at += 1 + len(node[2])
    return places


def votes(page: list, reference: list, w: Wrapper) -> list[tuple[int, int]]:
    """(number, equal) for the root and the matched texts of the reference.

    A text's vote is whether the page's node has it; the root's says that the page votes.
    """
    places = _places(reference)
    _, pairs = match(reference, page)
    same, cast = 0, [(0, 0)]
    for ours, theirs in pairs:
        mine, has = {h for h, _ in ours[2]}, {h for h, _ in theirs[2]}
        same += sum(n for h, n in theirs[2] if h in mine)
        at = places[id(ours)]
        cast += [(at + 1 + k, int(h in has)) for k, (h, _) in enumerate(ours[2])]
    everything = sum(n[1] for n in numbered(page))
    return [] if same > w.copy_share * everything else cast


def induce(reference: list, cast: dict[int, tuple[int, int]], w: Wrapper) -> dict:
    """The wrapper from votes {number: (pages, equal)}.

    `template` has the hashes of constant texts, `voted` says whether enough pages voted, `wide`
    whether the template holds for the whole host.
    """
    places = _places(reference)
    voters = cast.get(0, (0, 0))[0]
    needed = min(w.min_votes, max(w.least_votes, voters))
    template = []
    for node in numbered(reference):
        for k, (text, _) in enumerate(node[2]):
            pages, equal = cast.get(places[id(node)] + 1 + k, (0, 0))
            if equal >= needed and equal >= w.constant_share * pages:
                template.append(text)
    return {
        "template": sorted(set(template)), "voted": voters >= w.least_votes,
        "wide": voters >= w.min_votes,
    }


# ---------------------------------------------------------------- extraction


def page_texts(root: Node) -> list[tuple[bool, str]]:
    """(declared, text) of the page's blocks, noise left out.

    A text is declared content if it stands in an article or main element, or is an h1.
    """
    found = list(blocks(root, is_noise))
    if not any("article" in path or "main" in path for path, _ in found):
        return [(True, text) for _, text in found]
    return [("article" in path or "main" in path or "h1" in path, text) for path, text in found]


def main_text(texts: list[tuple[bool, str]], template: set[str], voted: bool) -> str:
    left = [(declared, text) for declared, text in texts if _hash(text) not in template]
    found = [text for declared, text in left if voted or declared]
    return "\n".join(found or [text for declared, text in texts if declared])


def extract(pages: DataFrame, w: Wrapper = Wrapper()) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    host = F.lower(F.coalesce(F.regexp_extract("url", r"(?s)://([^/?#]*)", 1), F.lit("")))
    rows = pages.select(
        F.col("page_id").cast("string").alias("page_id"), "url", "html", host.alias("host"),
        F.xxhash64("page_id", "url").alias("mark"),
    )
    key = ["host", "layout"]

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for page in pdf["html"]:
                root = parse(page or "")
                tree = compact(root)
                empty = not any(node[1] for node in numbered(tree))
                texts = json.dumps(page_texts(root), ensure_ascii=False)
                out.append((layout(tree), empty, json.dumps(tree), texts))
            found = pd.DataFrame(out, columns=["layout", "empty", "tree", "texts"], index=pdf.index)
            yield pdf[["page_id", "url", "host", "mark"]].join(found)

    trees = stored(
        rows.mapInPandas(
            shrink,
            "page_id string, url string, host string, mark long, layout string, empty boolean, "
            "tree string, texts string",
        ),
        "trees",
    )
    references = stored(
        trees.groupBy(key).agg(F.min(F.struct("empty", "mark", "tree")).alias("first"))
        .select(*key, F.col("first.tree").alias("reference")),
        "references",
    )

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for *name, tree, reference in zip(*(pdf[c] for c in (*key, "tree", "reference"))):
                cast = votes(json.loads(tree), json.loads(reference), w)
                out += [(*name, *v) for v in cast]
            yield pd.DataFrame(out, columns=[*key, "node", "equal"])

    cast = (
        trees.select(*key, "tree").join(references, key)
        .mapInPandas(vote, "host string, layout string, node int, equal int")
        .groupBy(*key, "node").agg(F.count("*").alias("pages"), F.sum("equal").alias("equal"))
        .groupBy(key).agg(F.collect_list(F.struct("node", "pages", "equal")).alias("cast"))
    )

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for reference, ballots in zip(pdf["reference"], pdf["cast"]):
                counted = {} if ballots is None else {
                    b["node"]: (b["pages"], b["equal"]) for b in ballots
                }
                found.append(induce(json.loads(reference), counted, w))
            yield pdf[key].assign(**{c: [x[c] for x in found] for c in ("template", "voted", "wide")})

    wrappers = stored(
        references.join(cast, key, "left").mapInPandas(
            learn, "host string, layout string, template array<string>, voted boolean, wide boolean"
        ),
        "wrappers",
    )
    wide = stored(
        wrappers.where("wide").select("host", F.explode("template").alias("text")).distinct()
        .groupBy("host").agg(F.collect_list("text").alias("everywhere")),
        "host-templates",
    )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for texts, own, everywhere, voted in zip(
                pdf["texts"], pdf["template"], pdf["everywhere"], pdf["voted"]
            ):
                template = {*own, *(() if everywhere is None else everywhere)}
                out.append(main_text(json.loads(texts), template, voted))
            yield pdf[["page_id", "url"]].assign(text=out)

    kind = pages.schema["page_id"].dataType
    text = (
        trees.select("page_id", "url", "texts", *key)
        .join(wrappers.drop("wide"), key).join(wide, "host", "left")
        .select("page_id", "url", "texts", "template", "everywhere", "voted")
        .mapInPandas(read, "page_id string, url string, text string")
    )
    return text.select(
        F.col("page_id").cast(kind), "url", "text", F.length("text").cast("long").alias("n_chars")
    )
