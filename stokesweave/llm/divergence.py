"""How far the sources of a language diverge in their use of its terms.

Every (language, source) group holds a segment tree over the kept terms of its language, whose leaves are the group's
counts.  Nodes are hash-consed: a node is its pair of children, so equal subtrees of counts, of one group or of several,
at one place or at several, are one node.  Two trees are walked together from their roots; a pair of nodes that is met
again, anywhere below, is the same pair, so it is opened once and counts as often as it was met.  Only distinct pairs of
leaves are priced.

A tree is cut at nodes of ``BLOCK`` leaves.  Spark deals the cut trees of ``TILE`` sources against those of ``TILE``
others, so a task holds two tiles of one block however many terms or sources a language has, and sums the prices of the
blocks of a pair.  Terms are in order of their count in the language: neighbours have like counts, and the rare ones, zero in most groups, share most of their nodes.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stokesweave.llm.common import pieces_of, text_of
from stokesweave.session import Stages

BLOCK = 4096  # leaves of a tree that one task holds, a power of two
TILE = 32  # mean number of sources in a tile
SCALE = 1_000_000_000
ADDED = 5  # added to every count
FLUSH = 200_000  # distinct terms that a task holds before it passes its counts on
STEP = 1 << 20  # bytes of a text that are split into words at once
ABSENT = -1  # the leaf of a place without a term

#: A-Z to a-z, every other byte below 128 that is no letter to a blank; bytes of other characters stay
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


# --- counts --------------------------------------------------------------------


def term_lists(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in lists of bounded size."""
    at = 0
    while at < len(text):
        piece = text[at : at + STEP].translate(WORDS)
        if at + STEP < len(text):  # a term that reaches over the end of the piece comes whole with the next one
            cut = piece.rfind(b" ")
            if cut < 0:  # one term longer than a piece
                rest = text[at:].translate(WORDS)
                cut = rest.find(b" ")
                piece = rest if cut < 0 else rest[:cut]
            else:
                piece = piece[: cut + 1]
        at += len(piece)
        yield piece.split()


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term, by language and source, of the rows of one task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for at in range(0, len(terms), 50_000):
                part = terms[at : at + 50_000]
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(part), pa.string()),
                        "source": pa.array([source] * len(part), pa.string()),
                        "term": pa.array(part, pa.binary()),
                        "n": pa.array([n[t] for t in part], pa.int64()),
                        "docs": pa.array([docs[t] for t in part], pa.int64()),
                    }
                )
        held.clear()

    size = 0
    for piece in pieces_of(batches):
        for lang, source, text in zip(*(c.to_pylist() for c in piece.columns)):
            n, docs = held[lang, source]
            size -= len(n)
            n[b""] += 0  # stands for the group itself, which may be without terms
            seen: set[bytes] = set()
            for terms in term_lists(text):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
            size += len(n)
            if size > FLUSH:
                yield from rows()
                size = 0
    yield from rows()


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term in a group, and the documents that hold it.

    A group without terms has the single row of the empty term.  Null text, language and source are empty strings.
    """
    narrow = docs.select(text_of(lang).alias("lang"), text_of(source).alias("source"), text_of(text).cast("binary").alias("text"))
    counts = narrow.mapInArrow(_count_batches, "lang string, source string, term binary, n long, docs long")
    return counts.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# --- trees ---------------------------------------------------------------------


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + ADDED) / total)``, exactly: three digits of the quotient at a time."""
    rest = counts.astype(object if total > (1 << 62) // 1000 else np.int64) + ADDED
    out = np.zeros_like(rest)
    for _ in range(3):
        out = out * 1000 + rest * 1000 // total
        rest = rest * 1000 % total
    return (out + 1).astype(np.int64)


class Forest:
    """Hash-consed trees over the rows of ``counts``, whose width is a power of two.

    ``roots[g]`` is the root of row g.  Level 0 are the leaves, ``values`` their counts; ``left[k]`` and ``right[k]``
    name the children, at level k - 1, of the nodes of level k.
    """

    def __init__(self, counts: np.ndarray) -> None:
        self.values, nodes = np.unique(counts, return_inverse=True)
        nodes = nodes.reshape(counts.shape)
        self.left: list[np.ndarray] = [np.empty(0, np.int64)]
        self.right: list[np.ndarray] = [np.empty(0, np.int64)]
        self.sizes = [len(self.values)]
        while nodes.shape[1] > 1:
            n = self.sizes[-1]
            pairs, found = np.unique(nodes[:, 0::2] * n + nodes[:, 1::2], return_inverse=True)
            nodes = found.reshape(nodes.shape[0], -1)
            self.left.append(pairs // n)
            self.right.append(pairs % n)
            self.sizes.append(len(pairs))
        self.roots = nodes[:, 0]


class Walk:
    """The joint walk of pairs of trees ``(a[i], b[i])``.

    ``pair``, ``x``, ``y`` and ``times`` are the distinct pairs of leaves: which two trees, which leaves, how often met.
    ``down[k]`` holds, for the distinct node pairs of level k, the places of their children among those of level k - 1.
    """

    def __init__(self, forest: Forest, a: np.ndarray, b: np.ndarray) -> None:
        top = len(forest.sizes) - 1
        pair, x, y = np.arange(len(a)), forest.roots[a], forest.roots[b]
        times = np.ones(len(a), np.int64)
        self.opened = len(a)
        self.down: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64),) * 2]
        for level in range(top, 0, -1):
            n = forest.sizes[level - 1]
            keys = [(pair * n + forest.left[level][x]) * n + forest.left[level][y], (pair * n + forest.right[level][x]) * n + forest.right[level][y]]
            distinct, found = np.unique(np.concatenate(keys), return_inverse=True)
            self.down.insert(1, (found[: len(x)], found[len(x) :]))
            times = np.bincount(found, np.concatenate([times, times]), len(distinct)).astype(np.int64)
            pair, x, y = distinct // (n * n), distinct // n % n, distinct % n
            self.opened += len(distinct)
        self.pair, self.x, self.y, self.times = pair, x, y, times


def _prices(forest: Forest, totals: list[int]) -> np.ndarray:
    """Share of every leaf value in every group; 0 where there is no term."""
    real = forest.values != ABSENT
    out = np.zeros((len(totals), len(forest.values)), np.int64)
    for g, total in enumerate(totals):
        out[g, real] = shares(forest.values[real], total)
    return out


def distances(forest: Forest, prices: np.ndarray, a: np.ndarray, b: np.ndarray, at_once: int = 512) -> np.ndarray:
    """Summed difference of the shares of trees a[i] and b[i]."""
    out = np.zeros(len(a), np.int64)
    for at in range(0, len(a), at_once):
        ga, gb = a[at : at + at_once], b[at : at + at_once]
        walk = Walk(forest, ga, gb)
        price = np.abs(prices[ga[walk.pair], walk.x] - prices[gb[walk.pair], walk.y])
        np.add.at(out, at + walk.pair, price * walk.times)
    return out


def excesses(forest: Forest, prices: np.ndarray, groups: np.ndarray, whole: int, best: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places where a group's share exceeds that of tree ``whole`` most: group, place, value.

    A group gets the places of its ``best`` largest values and all that tie with the last of them.  How often the walk met a
    pair of leaves tells the least value to be listed; only node pairs that lead to it are gone down again.
    """
    walk = Walk(forest, groups, np.full(len(groups), whole))
    value = prices[groups[walk.pair], walk.x] - prices[whole, walk.y]
    value = np.where((value > 0) & (forest.values[walk.x] > 0), value, 0)
    least = np.ones(len(groups), np.int64)
    order = np.lexsort((-value, walk.pair))
    seen = np.cumsum(walk.times[order])
    starts = np.searchsorted(walk.pair[order], np.arange(len(groups)))
    before = np.concatenate([[0], seen])[starts]
    enough = seen - before[walk.pair[order]] >= best
    np.maximum.at(least, walk.pair[order][enough], value[order][enough])
    reach = [value]
    for left, right in walk.down[1:]:
        reach.append(np.maximum(reach[-1][left], reach[-1][right]))
    tree, node, place = np.arange(len(groups)), np.arange(len(groups)), np.zeros(len(groups), np.int64)
    for level in range(len(walk.down) - 1, -1, -1):
        keep = reach[level][node] >= least[tree]
        tree, node, place = tree[keep], node[keep], place[keep]
        if level:
            left, right = walk.down[level]
            tree, place = np.repeat(tree, 2), np.repeat(place * 2, 2)
            place[1::2] += 1
            node = np.stack([left[node], right[node]], axis=1).ravel()
    return tree, place, value[node]


def _price_block(best: int):
    """Prices of one block of one tile pair: rows of kind 0 are sums of two sources, rows of kind 1 single terms.

    Input rows: ``place`` -1 with the group's denominator, others with a count; a null source is the language.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        first, second = key[2].as_py(), key[3].as_py()
        names = rows["source"].combine_chunks().dictionary_encode()
        found = names.dictionary.to_pylist()
        # sources in order, so that every block names the two of a pair alike, however its rows come
        labels = sorted(found)
        order = {label: g for g, label in enumerate(labels)}
        group = np.array([*(order[label] for label in found), len(labels)], np.int64)[names.indices.fill_null(len(found)).to_numpy()]
        place, n, tile = rows["place"].to_numpy(), rows["n"].to_numpy(), rows["tile"].to_numpy()
        whole = len(labels)
        width = rows["width"][0].as_py()
        counts = np.full((whole + 1, 1 << (width - 1).bit_length()), ABSENT, np.int64)
        terms = place[(group == whole) & (place >= 0)]
        counts[:, terms] = 0
        cell = place >= 0
        counts[group[cell], place[cell]] = n[cell]
        totals, tiles = [1] * (whole + 1), np.zeros(whole + 1, np.int64)
        for g, total, t in zip(group[~cell], n[~cell], tile[~cell]):
            totals[g], tiles[g] = int(total), t
        forest = Forest(counts)
        prices = _prices(forest, totals)
        groups = np.arange(whole)
        if first == second:
            a, b = np.triu_indices(whole, 1)
        else:
            mine, others = groups[tiles[:whole] == first], groups[tiles[:whole] == second]
            a, b = np.repeat(mine, len(others)), np.tile(others, len(mine))
        value = distances(forest, prices, a, b)
        kind, left, right, at = np.zeros(len(a), np.int32), a, b, np.full(len(a), -1, np.int32)
        if first == second and whole:
            tree, spot, gain = excesses(forest, prices, groups, whole, best)
            kind = np.concatenate([kind, np.ones(len(tree), np.int32)])
            left, right = np.concatenate([left, tree]), np.concatenate([right, tree])
            at, value = np.concatenate([at, spot.astype(np.int32)]), np.concatenate([value, gain])
        text = pa.array(labels, pa.string())
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()] * len(kind), pa.string()),
                "block": pa.array([key[1].as_py()] * len(kind), pa.int64()),
                "kind": pa.array(kind, pa.int32()),
                "source": text.take(pa.array(left, pa.int64())),
                "other": text.take(pa.array(right, pa.int64())),
                "place": pa.array(at, pa.int32()),
                "value": pa.array(value, pa.int64()),
            }
        )

    return run


# --- the audit -----------------------------------------------------------------


def _ranked(rows: DataFrame, part: str, best: int | None = None) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    out = rows.withColumn("rank", rank)
    if best is not None:
        out = out.where(F.col("rank") <= best)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _numbered(stages: Stages, terms: DataFrame, parts: int) -> DataFrame:
    """``lang, term, n, block, place``: every term's number in its language, by count, in blocks.

    Numbers are gapless however the rows are partitioned: a range partition tells a term's place among its neighbours, the sizes of the partitions
    before it, a short list, the rest.
    """
    order = ["lang", F.desc("n"), "term"]
    placed = stages.cut(terms.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    placed = placed.withColumn("part", F.shiftright("at", 33))
    starts = placed.groupBy("lang", "part").agg(F.min("at").alias("start"), F.count("*").alias("size"))
    earlier = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("lang", "part", "start", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    number = F.col("before") + F.col("at") - F.col("start")
    return placed.join(starts, ["lang", "part"]).select("lang", "term", "n", F.floor(number / BLOCK).alias("block"), (number % BLOCK).cast("int").alias("place"))


def _slot(n: Column, of: Column) -> Column:
    return F.pmod(F.xxhash64(of), F.greatest(F.lit(1), F.ceil(n / F.lit(TILE)))).cast("long")


def audit(docs: DataFrame, least: int = 30, best: int = 50, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group of language and source.

    A language keeps the terms that ``least`` or more of its documents hold.  Part ``pair`` has every other source of the
    language with the summed difference of shares, part ``term`` the ``best`` terms whose share in the group exceeds that in the
    language most.  Ranks run by value, largest first, then by item.

    Null text, language and source are read as empty strings, which are a group like any other; repeated rows count each.  A
    group without terms takes part with counts of zero; a language that keeps no term has values of 0 and no terms.  A language of one
    source has no pairs.  No documents give no rows.  Only the three named columns are read, so others cannot clash.
    """
    stages = Stages()
    counts = stages.cut(term_counts(docs, lang, source, text))
    real = counts.where("term <> ''")
    terms = real.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs")
    terms = stages.cut(terms)
    rows = terms.agg(F.count("*").alias("n")).first()["n"]
    numbered = stages.cut(_numbered(stages, terms, max(1, math.ceil(rows / (8 * BLOCK)))))
    kept = numbered.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("n"))
    cells = stages.cut(real.select("lang", "source", "term", "n").join(numbered.select("lang", "term", "block", "place"), ["lang", "term"]).drop("term"))

    seen = counts.select("lang", "source").distinct()
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    sizes = seen.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = seen.join(sums, ["lang", "source"], "left").join(sizes, "lang").join(kept.select("lang", "v"), "lang", "left")
    groups = stages.cut(
        groups.select("lang", "source", "sources", _slot(F.col("sources"), F.col("source")).alias("tile"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("n", F.lit(0)).alias("n"))
    )
    blocks = numbered.groupBy("lang", "block").agg((F.max("place") + 1).alias("width"))

    # what a task needs of a group: its denominator in every block and its counts
    total = (F.col("n") + ADDED * F.col("v")).alias("n")
    tiles = F.greatest(F.lit(1), F.ceil(F.col("sources") / F.lit(TILE)))
    every_tile = F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1))
    by_tile = blocks.join(sizes, "lang").select("lang", "block", "width", every_tile.alias("tile"))
    heads = groups.where("v > 0").select("lang", "source", "sources", "tile", total).join(by_tile, ["lang", "tile"]).withColumn("place", F.lit(-1))
    marks = groups.select("lang", "source", "sources", "tile")
    leaves = cells.join(marks, ["lang", "source"]).join(blocks, ["lang", "block"])
    columns = ["lang", "block", "source", "tile", "place", "n", "width"]
    own = heads.unionByName(leaves.select(*heads.columns)).withColumn("other", every_tile)
    own = own.select(*columns, F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"))
    # the language's own tree goes to every pair of tiles: its leaves tell the places that hold a term
    whole = numbered.select("lang", "block", "place", "n").unionByName(
        blocks.join(kept, "lang").select("lang", "block", F.lit(-1).alias("place"), (F.col("n") + ADDED * F.col("v")).alias("n"))
    )
    whole = whole.join(blocks, ["lang", "block"]).join(sizes, "lang").withColumn("first", every_tile)
    whole = whole.withColumn("second", F.explode(F.sequence(F.col("first"), tiles - 1))).select(
        "lang", "block", F.lit(None).cast("string").alias("source"), F.col("first").alias("tile"), "place", "n", "width", "first", "second"
    )
    schema = "lang string, block long, kind int, source string, other string, place int, value long"
    priced = stages.cut(own.unionByName(whole).groupBy("lang", "block", "first", "second").applyInArrow(_price_block(best), schema))

    sums = priced.where("kind = 0").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    both = sums.select("lang", "source", F.col("other").alias("item"), "value").unionByName(sums.select("lang", F.col("other").alias("source"), F.col("source").alias("item"), "value"))
    # languages that keep no term have pairs all the same
    idle = groups.where("v = 0").select("lang", "source")
    none = idle.join(idle.withColumnRenamed("source", "item"), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    found = priced.where("kind = 1").select("lang", "block", "place", "source", "value").join(numbered.select("lang", "block", "place", F.col("term").alias("item")), ["lang", "block", "place"])
    return _ranked(both.unionByName(none), "pair").unionByName(_ranked(found.select("lang", "source", "item", "value"), "term", best))


def oracle(least: int = 30, best: int = 50) -> str:
    """The audit in DuckDB's SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    share = "1 + (CAST({n} AS HUGEINT) + 5) * 1000000000 // ({total} + 5 * {v})"
    return rf"""
    WITH d AS (SELECT ROW_NUMBER() OVER () AS rid, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source, COALESCE(text, '') AS text FROM documents),
    w AS (SELECT rid, lang, source, UNNEST(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    c AS (SELECT rid, lang, source, term, COUNT(*) AS n FROM w GROUP BY ALL),
    t AS (SELECT lang, term, SUM(n) AS n FROM c GROUP BY lang, term HAVING COUNT(*) >= {least}),
    l AS (SELECT lang, COUNT(*) AS v, SUM(n) AS total FROM t GROUP BY lang),
    g AS (SELECT DISTINCT lang, source FROM d),
    k AS (SELECT c.lang, c.source, c.term, SUM(c.n) AS n FROM c JOIN t USING (lang, term) GROUP BY ALL),
    s AS (SELECT g.lang, g.source, COALESCE(SUM(k.n), 0) AS total FROM g LEFT JOIN k USING (lang, source) GROUP BY ALL),
    p AS (SELECT s.lang, s.source, t.term, COALESCE(k.n, 0) AS n, {share.format(n="COALESCE(k.n, 0)", total="s.total", v="l.v")} AS p, {share.format(n="t.n", total="l.total", v="l.v")} AS q
      FROM s JOIN l USING (lang) JOIN t USING (lang) LEFT JOIN k ON k.lang = s.lang AND k.source = s.source AND k.term = t.term),
    x AS (SELECT a.lang, a.source, b.source AS item, SUM(ABS(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(COALESCE(x.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
    terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
    r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
    SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {best}"""
