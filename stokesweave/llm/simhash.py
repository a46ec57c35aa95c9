"""SimHash fingerprints and their links by a generalised pigeonhole principle.

If two fingerprints differ in at most ``radius`` bits and the bits are cut into parts with
thresholds ``t`` whose sum is ``radius - parts + 1`` (a part with -1 is skipped), then in at least one part
they differ in at most its ``t`` bits.  Correlated bits share a part; a dynamic programme
chooses the thresholds by the estimated signatures and candidates of each part.  Candidates of a part
are found by an equi-join on the part's value, probing all values within ``t`` bits, and verified.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stokesweave.llm.common import map_texts, pieces_of, text_of
from stokesweave.llm.components import components
from stokesweave.session import Stages, cut_lineage

BITS = 64


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 (seed 42) of the text's word shingles, repeats included; the whole sequence if it is shorter."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], dtype=np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]]).tolist()
    ends = (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :])], dtype=np.uint64)


def fingerprint(text: str, width: int) -> int:
    """Bits set in over half the shingle hashes, as a signed 64-bit number; 0 without words."""
    hashes = shingle_hashes(text, width)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp`` of every row; null texts count as empty and have fingerprint 0."""

    def run(keys: list, texts: list[str]) -> dict[str, list]:
        return {key: keys, "fp": [fingerprint(t, width) for t in texts]}

    return map_texts(df, run, f"`{key}` {df.schema[key].dataType.simpleString()}, fp bigint", key, text)


def bits_of(batch: pa.RecordBatch, words: list[str]) -> np.ndarray:
    """The bits of the fingerprints in these columns, a row each."""
    raw = np.stack([batch.column(w).to_numpy(zero_copy_only=False).astype("<i8") for w in words], axis=1)
    return np.unpackbits(np.ascontiguousarray(raw).view(np.uint8), axis=1, bitorder="little")


def bit_counts(fps: DataFrame, words: list[str] | None = None, block: int = 256) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each pair of bits, how many have both set.

    Fingerprints longer than ``block`` bits are counted block by block; bits of different blocks are taken as independent.
    """
    words = words or ["fp"]
    long = BITS * len(words)
    starts = range(0, long, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [np.zeros((min(block, long - at),) * 2) for at in starts], 0
        for batch in batches:
            bits = bits_of(batch, words).astype(np.float32)
            total, n = [t + bits[:, at : at + block].T @ bits[:, at : at + block] for at, t in zip(starts, total)], n + len(bits)
        schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("n", pa.int64())])
        for at, t in zip(starts, total):
            i, j = np.indices(t.shape).reshape(2, -1) + at
            yield pa.RecordBatch.from_pydict({"i": i, "j": j, "n": t.astype(np.int64).ravel()}, schema=schema)
        yield pa.RecordBatch.from_pydict({"i": [-1], "j": [-1], "n": [n]}, schema=schema)

    both, size = np.full((long, long), np.nan), 0
    for row in fps.select(*words).mapInArrow(run, "i int, j int, n bigint").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        if row["i"] < 0:
            size = row["n"]
        else:
            both[row["i"], row["j"]] = row["n"]
    one = np.nan_to_num(np.diag(both))
    return size, np.where(np.isnan(both), np.outer(one, one) / max(size, 1), both)


def group_bits(n: int, both: np.ndarray, parts: int, width: int | None = None) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size, or of ``width`` bits each; correlated bits go together."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, groups = set(range(len(both))), []
    for g in range(parts):
        size = width or (len(both) - sum(map(len, groups))) // (parts - g)
        left = sorted(free)
        group = [left[int(np.argmax(corr[np.ix_(left, left)].sum(axis=1)))]]
        free.discard(group[0])
        while len(group) < size:
            left = sorted(free)
            group.append(left[int(np.argmax(corr[np.ix_(left, group)].sum(axis=1)))])
            free.discard(group[-1])
        groups.append(sorted(group))
    return groups


def near_probability(differ: np.ndarray, most: int) -> np.ndarray:
    """Chance that two fingerprints differ in 0, at most 1, ... bits of a part, bits taken as independent."""
    chance = np.zeros(most + 1)
    chance[0] = 1
    for d in differ:
        chance[1:] = chance[1:] * (1 - d) + chance[:-1] * d
        chance[0] *= 1 - d
    return np.cumsum(chance)


def allocate(cost: list[list[float]], radius: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost: ``cost[part][t + 1]`` for t from -1, sum of ``t + 1`` equal to ``radius + 1``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in cost:
        after: dict[int, tuple[float, list[int]]] = {}
        for spent, (total, chosen) in best.items():
            for more, c in enumerate(part):
                at = spent + more
                if at <= radius + 1 and (at not in after or total + c < after[at][0]):
                    after[at] = (total + c, [*chosen, more - 1])
        best = after
    return best[radius + 1]


def part_value(fp: Column, bits: list[int]) -> Column:
    """The bits of a part; the others are zero."""
    mask = sum(1 << b for b in bits)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint"))


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def choose_parts(fps: DataFrame, radius: int) -> list[tuple[list[int], int]]:
    """Parts and thresholds: for each number of parts the thresholds by dynamic programming, then the cheapest number.

    The pairs that agree on a part are counted over all fingerprints; those within one or
    more bits are the counted ones scaled by the ratio that independent bits would have.
    """
    n, both = bit_counts(fps)
    one = np.diag(both) / max(n, 1)
    differ = 2 * one * (1 - one)
    plans = []
    layouts = {m: group_bits(n, both, m) for m in range(2, radius + 2)}
    for m, groups in layouts.items():
        costs = []
        for g in groups:
            equal = fps.groupBy(part_value(F.col("fp"), g)).count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0] or 0.0
            near = near_probability(differ[g], radius)
            costs.append([0.0] + [n * (1.0 + sum(comb(len(g), i) for i in range(t + 1))) + equal * near[t] / max(near[0], 1e-30) for t in range(radius + 1)])
        total, thresholds = allocate(costs, radius)
        plans.append((total, [(g, t) for g, t in zip(groups, thresholds) if t >= 0]))
    return min(plans, key=lambda p: p[0])[1]


def _within(part: int, bits: list[int], most: int) -> Column:
    """All values of a part within ``most`` bits of the fingerprint's own."""
    own = part_value(F.col("fp"), bits)
    flips = [signed(sum(1 << b for b in c)) for size in range(most + 1) for c in combinations(bits, size)]
    return F.transform(F.array(*[F.lit(f).cast("bigint") for f in flips]), lambda f: F.struct(F.lit(part).alias("part"), own.bitwiseXOR(f).alias("value")))


def links_within(fps: DataFrame, radius: int, crowded: int = 32) -> DataFrame:
    """``a, b``: links that join all fingerprints of ``fps (fp)`` within ``radius`` bits; fp is unique.

    Values of a part with up to ``crowded`` fingerprints give candidate pairs, which are verified.  A
    fingerprint that meets a fuller value goes another way, exact for radius 2: two fingerprints
    are within two bits exactly if some value is within one bit of both, so each is listed
    under itself and its 64 neighbours, and all under one value (65 at most) hang on their smallest.
    """
    if radius != 2:
        raise ValueError("links are built for radius 2")
    parts = choose_parts(fps, radius)
    index = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("part"), part_value(F.col("fp"), g).alias("value")) for i, (g, _) in enumerate(parts)])).alias("s")).select("fp", "s.part", "s.value")
    probes = fps.select("fp", F.explode(F.flatten(F.array(*[_within(i, g, t) for i, (g, t) in enumerate(parts)]))).alias("s")).select("fp", "s.part", "s.value")
    sizes = cut_lineage(index.groupBy("part", "value").agg(F.count("*").alias("n")).filter("n > 1" if all(t == 0 for _, t in parts) else "n > 0"))
    full = sizes.filter(F.col("n") > crowded)
    small = index.join(sizes.filter(F.col("n") <= crowded), ["part", "value"]).select("part", "value", F.col("fp").alias("fp2"))
    pairs = (
        probes.join(small, ["part", "value"])
        .filter((F.col("fp") != F.col("fp2")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= radius))
        .select(F.least("fp", "fp2").alias("a"), F.greatest("fp", "fp2").alias("b"))
    )
    busy = probes.join(full, ["part", "value"], "left_semi").unionByName(index.join(full, ["part", "value"], "left_semi")).select("fp").distinct()
    flips = F.array(*[F.lit(f).cast("bigint") for f in [0, *[signed(1 << b) for b in range(BITS)]]])
    around = busy.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("value"))
    stars = (
        around.groupBy("value")
        .agg(F.collect_set("fp").alias("fps"))
        .filter(F.size("fps") > 1)
        .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
        .filter("a <> b")
    )
    return pairs.unionByName(stars)


def near_duplicates(df: DataFrame, width: int = 3, radius: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint, component_id`` of every row: the smallest key reachable over links of at most ``radius`` bits.

    Equal fingerprints are one node whatever their number, so copies cost nothing beyond their own
    rows.  Null and empty texts have fingerprint zero and link like any other.  Repeated rows
    and rows with equal keys each give a row.  Null keys are passed over when the smallest is taken.
    Other columns are not carried.
    """
    rows = cut_lineage(fingerprints(df, width, key, text).select(F.col(key).alias("key"), "fp"))
    fps = cut_lineage(rows.groupBy("fp").agg(F.min("key").alias("least")))
    comp = components(links_within(fps, radius))
    linked = cut_lineage(comp.join(fps, comp["node"] == fps["fp"]).select("fp", "component", "least"))
    least = cut_lineage(linked.groupBy("component").agg(F.min("least").alias("component_id")))
    named = linked.select("fp", "component").join(least, "component").select("fp", "component_id")
    # fingerprints without links answer for themselves
    all_named = cut_lineage(fps.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")))
    return rows.join(all_named, "fp").select(F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# -- similar texts ----------------------------------------------------------------------



WORDS64 = 4  # 64-bit words of a fingerprint that are compared, and of a parity map
MOST = 2  # bits that two values of a part may differ in at most
GAIN_STEPS = 12
RECALL = 0.99  # chance that two texts at the similarity meet in some part, whatever the number of texts


def bits_apart(similarity: float) -> float:
    """Share of bits in which the fingerprints of two texts at this similarity differ."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def layout(nodes: int, similarity: float, recall: float = RECALL) -> tuple[int, int]:
    """Width of a part in bits, and how many parts a fingerprint has, for so many nodes.

    A part grows with log2(nodes), so that few nodes share its value by chance; wider parts meet more
    rarely, so the number of parts grows with them until two texts at the similarity agree in some part, or
    differ there in one bit, with a chance of ``recall``.
    """
    bits = min(30, max(12, (max(2, nodes) - 1).bit_length()))
    meet = near_probability(np.full(bits, bits_apart(similarity)), 1)[1]
    needed = int(np.ceil(np.log(1 - recall) / np.log(1 - meet))) if meet < 1 else 1
    return bits, max(WORDS64 * BITS // bits, needed)


def allocate_for(cost: list[list[float]], gain: list[int], goal: int) -> tuple[float, list[int]] | None:
    """Thresholds of least total cost whose gains sum to ``goal`` or more; none if no thresholds do.

    ``cost[part][t + 1]`` and ``gain[t + 1]`` for t from -1, which skips the part.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in cost:
        after: dict[int, tuple[float, list[int]]] = {}
        for got, (total, chosen) in best.items():
            for more, (c, g) in enumerate(zip(part, gain)):
                at = min(goal, got + g)
                if at not in after or total + c < after[at][0]:
                    after[at] = (total + c, [*chosen, more - 1])
        best = after
    return best.get(goal)


def with_slots(df: DataFrame, words: list[str], marked: list[tuple[int, list[int]]]) -> DataFrame:
    """Rows with ``slots``: for each mark and group of bits the value of the fingerprint's part, plus the mark."""
    schema = T.StructType([*df.schema.fields, T.StructField("slots", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = bits_of(batch, words)
            values = np.empty((len(bits), len(marked)), dtype=np.int64)
            for at, (mark, group) in enumerate(marked):
                values[:, at] = bits[:, group] @ (np.int64(1) << np.arange(len(group))) + mark
            ends = np.arange(len(bits) + 1, dtype=np.int32) * len(marked)
            slots = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, slots], names=[*batch.schema.names, "slots"])

    return df.mapInArrow(run, schema)


def choose_similar_parts(fps: DataFrame, words: list[str], nodes: int, similarity: float) -> list[tuple[list[int], int]]:
    """Parts and thresholds of long fingerprints: as ``choose_parts``, for a chance to meet in place of a radius.

    Two texts at the similarity meet with at least the chance that ``layout`` gives with one bit in each of its parts. For
    that width of a part, one narrower and one wider, thresholds up to two bits come by dynamic programming over the parts: each is priced
    by its signatures and its pairs, counted over all fingerprints, and gains what it takes off the logarithm of the
    chance to miss, in steps of a twelfth of a part with one bit, rounded down. The cheapest width is taken.
    """
    n, both = bit_counts(fps, words)
    one = np.diag(both) / max(n, 1)
    differ = 2 * one * (1 - one)
    bits, parts = layout(nodes, similarity)

    def hit(width: int) -> np.ndarray:
        return -np.log1p(-near_probability(np.full(width, bits_apart(similarity)), MOST))

    step = hit(bits)[1] / GAIN_STEPS
    layouts = [group_bits(n, both, min(parts if w == bits else len(both), len(both) // w), w) for w in (bits, bits - 2, bits + 2) if 12 <= w <= 30]
    marked = [(i << 32, g) for i, g in enumerate(g for groups in layouts for g in groups)]
    slot = with_slots(fps.select(*words), words, marked).select(F.explode("slots").alias("slot"))
    pairs = slot.groupBy("slot").count().groupBy(F.shiftright("slot", 32).alias("part")).agg(F.sum(F.col("count") * (F.col("count") - 1) / 2).alias("n"))
    equal = {r["part"]: r["n"] for r in pairs.collect()}
    plans, at = [], 0
    for groups in layouts:
        costs = []
        for g in groups:
            near = near_probability(differ[g], MOST)
            costs.append([0.0] + [n * (1.0 + sum(comb(len(g), i) for i in range(t + 1))) + equal.get(at, 0.0) * near[t] / max(near[0], 1e-30) for t in range(MOST + 1)])
            at += 1
        gain = [0, *(int(h / step + 1e-6) for h in hit(len(groups[0])))]
        found = allocate_for(costs, gain, GAIN_STEPS * parts)
        if found is not None:
            plans.append((found[0], [(g, t) for g, t in zip(groups, found[1]) if t >= 0]))
    return min(plans, key=lambda p: p[0])[1]


def words_needed(nodes: int, similarity: float) -> int:
    """64-bit words that the parts of this or any smaller number of nodes take."""
    sizes = {1 << e for e in range(1, max(2, nodes).bit_length())} | {nodes}
    return max(WORDS64, *[-(-bits * parts // BITS) for bits, parts in (layout(n, similarity) for n in sizes)])


def wide_fingerprint(hashes: np.ndarray, words: int = WORDS64) -> list[int]:
    """A fingerprint of 64 bits a word from shingle hashes: the hashes and remixed copies of them, 64 bits each."""
    ones = np.zeros(words * BITS, dtype=np.int64)
    step = 65536 * WORDS64 // words
    for at in range(0, len(hashes), step):
        part = hashes[at : at + step]
        streams = []
        for i in range(words):
            x = part ^ np.uint64(0x9E3779B97F4A7C15 * i % 2**64)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
            streams.append(x ^ (x >> np.uint64(31)))
        ones += np.unpackbits(np.stack(streams, axis=1).astype("<u8").view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8").tolist()


def parity_map(hashes: np.ndarray) -> list[int]:
    """256 bits: whether each of 256 buckets holds an odd number of the distinct hashes.

    The maps of two sets differ in at most as many bits as the sets differ in elements.
    """
    odd = np.bincount((hashes >> np.uint64(56)).astype(np.int64), minlength=WORDS64 * BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


FP, ODD = [f"f{w}" for w in range(WORDS64)], [f"p{w}" for w in range(WORDS64)]
CARRIED = ["node", "n", *FP, *ODD]


def similar_groups(df: DataFrame, width: int = 5, similarity: float = 0.8, crowded: int = 32, leaders: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, component_id, text_hash, component_hash``: groups of texts that reach each other over links of a Jaccard similarity of word shingles.

    ``component_id`` is the group's smallest key, and ``component_hash`` the hash of its text, as two texts may share a key.

    Texts of the same shingle set are one node.  Fingerprints are cut into parts of about log2(number of nodes)
    bits, correlated bits together, and each part gets a threshold by dynamic programming (``choose_similar_parts``); nodes that differ
    on a part in no more bits than its threshold are compared.  They are
    candidates if their shingle counts and parity maps allow the similarity (which no pair at the
    similarity fails) and the first 256 bits of the fingerprints differ in no more bits than the similarity makes likely, and
    links if their shingle sets are as similar.  Fingerprints are longer the more nodes there are (``layout``), so two texts at
    the similarity meet in some part with a chance of ``RECALL`` at any size, more similar ones nearly always.

    Values of a part that more than ``crowded`` nodes share are first compared with the ``leaders`` that share
    values with most others, which are the texts that a group of edited copies has in common.  Most nodes of
    such a value are then in one group; those that are not are compared with all that meet the value,
    so nothing is left out.  Pairs that are in one group already are not looked at again.

    Null and empty texts have no shingles and form one group.  Rows with a null key take no part.
    """

    def run(keys: list, texts: list[str]) -> dict[str, list]:
        sets = [np.unique(shingle_hashes(t, width)) for t in texts]
        wide, odd = [wide_fingerprint(s, len(all_words)) for s in sets], [parity_map(s) for s in sets]
        out = {"key": keys, "text_hash": [signed(xxhash.xxh64_intdigest(t, 42)) for t in texts], "node": [xxhash.xxh64_intdigest(s.tobytes()) - 2**63 for s in sets], "n": [len(s) for s in sets]}
        return out | {c: [x[w] for x in wide] for w, c in enumerate(all_words)} | {c: [x[w] for x in odd] for w, c in enumerate(ODD)}

    stages = Stages()
    kind = df.schema[key].dataType.simpleString()
    known = df.filter(F.col(key).isNotNull())
    all_words = [f"f{w}" for w in range(words_needed(known.count(), similarity))]
    stored = ["node", "n", *all_words, *ODD]
    longs = ", ".join(f"{c} bigint" for c in stored)
    rows = stages.cut(map_texts(known, run, f"key {kind}, text_hash bigint, {longs}", key, text))
    lowest_row = F.min(F.struct("key", "text_hash")).alias("row")
    unsliced = stages.cut(rows.groupBy("node").agg(lowest_row, *[F.first(c).alias(c) for c in stored[1:]]))
    chosen_parts = choose_similar_parts(unsliced.filter("n > 0"), all_words, unsliced.count(), similarity)
    # a slot is a part's number, its threshold in bits 30 and 31, and the value
    nodes = stages.cut(with_slots(unsliced, all_words, [(i << 32 | t << 30, g) for i, (g, t) in enumerate(chosen_parts)]).select("node", "row", "n", *FP, *ODD, "slots"))
    stages.drop(unsliced)

    def slots(of: DataFrame, *more: str) -> DataFrame:
        """A row for each part of a node's fingerprint; only the columns named travel with it."""
        return of.filter("n > 0").select("node", *more, F.explode("slots").alias("slot"))

    narrow = slots(nodes)
    counts = stages.cut(narrow.groupBy("slot").agg(F.count("*").alias("members")))
    full = stages.cut(counts.filter(F.col("members") > crowded))
    stages.drop(counts)

    def reach(words: int) -> int:
        """The farthest that a pair at this similarity is likely to lie, four standard deviations out."""
        differ = bits_apart(similarity)
        return int(words * BITS * differ + 4 * np.sqrt(words * BITS * differ * (1 - differ)))

    def apart(words: list[str]) -> Column:
        return sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"{w}_2"))) for w in words), F.lit(0))

    # sets at the similarity differ in at most this share of their summed sizes, and so do their parity maps
    share = (1 - similarity) / (1 + similarity)

    def alike(fp: list[str], odd: list[str]) -> Column:
        return (
            (F.col("node") != F.col("node_2"))
            & (F.least("n", "n_2") >= F.greatest("n", "n_2") * F.lit(similarity - 1e-9))
            & (apart(odd) <= (F.col("n") + F.col("n_2")) * F.lit(share) + F.lit(1e-6))
            & (apart(fp) <= reach(len(fp)))
        )

    pair = [F.least("node", "node_2").alias("a"), F.greatest("node", "node_2").alias("b")]
    bits, thresholds = len(chosen_parts[0][0]), {t for _, t in chosen_parts}
    flips = [sum(1 << b for b in c) for size in range(1, max(thresholds) + 1) for c in combinations(range(bits), size)]

    def probes(of: DataFrame, flips: list[int], when: Callable[[Column], Column]) -> DataFrame:
        """Rows at the values that ``flips`` lead to from their own within the part's threshold, where ``when(value)`` holds."""
        most = F.shiftright("slot", 30).bitwiseAND(F.lit(3).cast("bigint"))
        listed = F.array(*[F.lit(f).cast("bigint") for f in flips]).cast("array<bigint>")
        some = listed if len(thresholds) == 1 else F.filter(listed, lambda f: F.bit_count(f) <= most)
        return of.withColumn("slot", F.explode(F.filter(F.transform(some, lambda f: F.col("slot").bitwiseXOR(f)), when)))

    def other(of: DataFrame) -> DataFrame:
        return of.select("slot", *[F.col(c).alias(f"{c}_2") for c in of.columns if c != "slot"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                s, t = (np.unique(shingle_hashes(v, width)) for v in (x, y))
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(both >= similarity * (len(s) + len(t) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def links(found: DataFrame) -> DataFrame:
        """The candidate pairs that are as similar, by the shingles of one text of each node."""
        pairs = stages.cut(found.distinct())
        asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes, "node").select("node", "row.key", "row.text_hash")
        named = df.select(F.col(key).alias("key"), text_of(text).alias("text")).withColumn("text_hash", F.xxhash64("text"))
        texts = stages.cut(named.join(asked, ["key", "text_hash"]).groupBy("node").agg(F.max("text").alias("text")))
        similar = stages.cut(
            pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
            .select("a", "b", "x", "y")
            .mapInArrow(verify, "a bigint, b bigint")
        )
        stages.drop(pairs, texts)
        return similar

    # crowded values first: their leaders go to all values within the part's threshold
    members = narrow.join(full, "slot")
    weight = stages.cut(members.groupBy("node").agg(F.sum("members").alias("weight")))
    rank = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("weight"), "node"))
    chosen = stages.cut(members.join(weight, "node").withColumn("rank", rank).filter(F.col("rank") <= leaders).select("slot", "node"))
    heads = stages.cut(chosen.join(nodes.select(*CARRIED), "node"))
    led = links(slots(nodes, *CARRIED[1:]).join(other(probes(heads, [0, *flips], lambda v: F.lit(True))), "slot").filter(alike(FP, ODD)).select(*pair))
    stages.drop(weight, chosen, heads)

    # then all others that are not in the same group yet; of a crowded value those outside its largest group.
    # half of the fingerprint and of a parity map of half as many buckets travel, the whole is compared afterwards
    joined = components(led).withColumnRenamed("component", "group")
    half = [F.col(ODD[w]).bitwiseXOR(F.col(ODD[w + WORDS64 // 2])).alias(f"q{w}") for w in range(WORDS64 // 2)]
    grouped = stages.cut(nodes.join(joined, "node", "left").withColumn("group", F.coalesce("group", "node")).select("node", "group", "n", *FP[: WORDS64 // 2], "slots", *half))
    light = ["group", "n", *FP[: WORDS64 // 2], *[f"q{w}" for w in range(WORDS64 // 2)]]
    largest = stages.cut(
        slots(grouped, "group").join(full.select("slot"), "slot", "left_semi").groupBy("slot", "group").agg(F.count("*").alias("n")).groupBy("slot").agg(F.max_by("group", F.struct("n", "group")).alias("main"), F.max("n").alias("held"))
    )
    # every part of every node is listed once, with the largest group of its value if that is crowded; all joins below read this list
    listed = stages.cut(slots(grouped, *light).join(largest.select("slot", "main"), "slot", "left"))
    stages.drop(grouped)
    rest = listed.filter("main is null or group <> main").drop("main")
    main = listed.filter("group = main").drop("main")
    # of two values apart the smaller asks; in the largest group of a crowded value, which is not asked, both do
    asks = probes(listed.drop("main"), [0, *flips], lambda v: v >= F.col("slot"))
    asks = asks.unionByName(probes(main, flips, lambda v: v < F.col("slot")))

    def meeting(asking: DataFrame, asked: DataFrame) -> DataFrame:
        return asking.join(other(asked), "slot").filter(alike(light[2 : 2 + WORDS64 // 2], light[2 + WORDS64 // 2 :]) & (F.col("group") != F.col("group_2"))).select(*pair)

    found = meeting(asks, rest)
    # the largest groups of two crowded values within a part's threshold are asked by neither; where they differ, the larger asks the smaller
    near_by = probes(largest.withColumn("at", F.col("slot")), flips, lambda v: v > F.col("slot")).join(other(largest), "slot").filter("main <> main_2")
    first = F.col("held") >= F.col("held_2")
    bridges = stages.cut(near_by.select(F.when(first, F.col("at")).otherwise(F.col("slot")).alias("from"), F.when(first, F.col("slot")).otherwise(F.col("at")).alias("to")))
    if not bridges.isEmpty():
        across = main.join(bridges, F.col("slot") == F.col("from")).withColumn("slot", F.col("to")).drop("from", "to")
        found = found.unionByName(meeting(across, main.join(bridges.select(F.col("to").alias("slot")).distinct(), "slot", "left_semi")))
    met = stages.cut(found.distinct())
    stages.drop(listed, largest, full, bridges)
    signs = nodes.select(*CARRIED)
    whole = met.join(signs.withColumnRenamed("node", "a"), "a").join(signs.select(*[F.col(c).alias("b" if c == "node" else f"{c}_2") for c in CARRIED]), "b")
    near = links(whole.withColumns({"node": F.col("a"), "node_2": F.col("b")}).filter(alike(FP, ODD)).select("a", "b"))
    comp = components(led.unionByName(near))
    linked = stages.cut(comp.join(nodes.select("node", "row"), "node"))
    stages.drop(met, led, near)
    lowest = stages.cut(linked.groupBy("component").agg(F.min("row").alias("first")))
    named = stages.cut(linked.join(lowest, "component").select("node", "first"))
    all_named = stages.cut(nodes.join(named, "node", "left").select("node", F.coalesce("first", "row").alias("first")))
    stages.drop(nodes, linked, lowest, named)
    return rows.join(all_named, "node").select(F.col("key").alias(key), F.col("first.key").alias("component_id"), "text_hash", F.col("first.text_hash").alias("component_hash"))


def keep_one(df: DataFrame, groups: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of each group whose key and text name it, all columns; of repeated rows one.  Rows with a null key are kept."""
    named = groups.filter((F.col(key) == F.col("component_id")) & (F.col("text_hash") == F.col("component_hash"))).select(key, F.col("text_hash").alias("__hash")).distinct()
    first = F.row_number().over(Window.partitionBy(key, "__hash").orderBy(F.lit(1)))
    hashed = df.withColumn("__hash", F.xxhash64(text_of(text)))
    kept = hashed.join(named, [key, "__hash"], "left_semi").withColumn("__first", first).filter("__first = 1").select(*df.columns)
    return kept.unionByName(df.filter(F.col(key).isNull()))
