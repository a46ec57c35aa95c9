"""Text operators against brute force, round trips and held-out accuracy, with nulls, empties, repeats and empty tables."""

import base64
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from stokesweave.llm import bottom_k, byte_bpe, html_mincut, licenses, line_dedup, ngram_lm, packing, simhash, topk, toxicity  # noqa: E402
from stokesweave.llm.components import components  # noqa: E402

SCHEMA = "doc_id long, text string, source string, score string"
BASE = "The quick brown fox jumps over the lazy dog while seven wise owls watch from the old oak tree near the river bank".split()


def texts(n=40, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    body = texts()
    body[5] = body[4]
    body[6] = None
    body[7] = ""
    body[8] = "x" * 5000 + " MIT License. "
    body[9] = " \n\t "
    rows = [(i, t, f"s{i % 12}", "clash") for i, t in enumerate(body)]
    return spark.createDataFrame(rows + [rows[3]], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_min_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randint(1, 7)
        odds = [rng.uniform(-1, 1) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 0.8)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def cost(s):
            return sum(max(-o, 0) if x else max(o, 0) for o, x in zip(odds, s)) + sum(w for a, b, w in edges if s[a] != s[b])

        assert cost(html_mincut.minimum_cut(odds, edges)) == pytest.approx(min(cost(s) for s in itertools.product([False, True], repeat=n)))


def test_html(spark):
    page = (
        "<html><head><title>T</title><script>var a='</p>'</script></head><body><nav><a href=x>Home</a></nav><div class='sidebar'>Other things to read here today.</div>"
        "<article><header><h1>A &amp; B</h1></header><p>First   line<br>goes on here.<p>Second <b>one</b> is a sentence.</article>"
        "<section id=comments><p>I am a reader and I think so too, really.</p></section><footer>&copy; me</footer></body>"
    )
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "v", ""), (None, "w", "<p>a<")]
    out = html_mincut.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = "A & B\nFirst line goes on here.\nSecond one is a sentence."
    assert [r["text"] for r in out if r["page_id"] == 1] == [want, want] and len(out) == 5
    assert all(r["n_chars"] == len(r["text"]) for r in out)


def test_byte_bpe_equals_the_library(docs, nothing):
    tiktoken = pytest.importorskip("tiktoken")
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    enc = byte_bpe.encoder(path, P.PATTERN)
    rng = random.Random(2)
    for _ in range(2000):
        t = "".join(rng.choice(" \t\n\x1c\x85 '’sdtreAé1²½!._日🎉") for _ in range(rng.randint(0, 30)))
        assert enc.encode(t) == ref.encode_ordinary(t)
    for t in ("ab" * 5000, "z" * 3000, ""):
        assert enc.encode(t) == ref.encode_ordinary(t) and enc.decode(enc.encode(t)) == t.encode()
    out = byte_bpe.encode_digest(docs, path, P.PATTERN).collect()
    assert len(out) == 41
    by = {r["doc_id"]: (r["text"] or "") for r in docs.collect()}
    for r in out:
        ids = ref.encode_ordinary(by[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(by[r["doc_id"]].encode()).hexdigest()
    assert byte_bpe.encode_digest(nothing, path, P.PATTERN).count() == 0
    back = byte_bpe.decode(byte_bpe.encode(docs, path, P.PATTERN), path, P.PATTERN).collect()
    assert sorted(bytes(r["data"]).decode() for r in back) == sorted([*by.values(), by[3]])


def test_best_fill_is_best():
    rng = random.Random(5)
    for _ in range(100):
        counts = [0] * 21
        for _ in range(rng.randint(0, 6)):
            counts[rng.randint(1, 20)] += 1
        used, total = packing.best_fill(counts, 20, 20)
        items = [length for length, n in enumerate(counts) for _ in range(n)]
        best = max(sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k) if sum(c) <= 20)
        assert total == best == sum(length * n for length, n in used.items()) and all(n <= counts[length] for length, n in used.items())


def test_packing_covers_each_id_once(docs, nothing):
    tokenizers = pytest.importorskip("tokenizers")
    path = P.path("byte_bpe_50k.json")
    tok = tokenizers.Tokenizer.from_file(path)
    rows = packing.pack(docs, path, window=64, spare_share=3).collect()
    ids = {r["doc_id"]: [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
    pieces, seqs = {}, {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces.setdefault(r["doc_id"], []).append(r["length"])
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert {k: sum(v) for k, v in pieces.items()} == {k: len(v) * (2 if k == 3 else 1) for k, v in ids.items()}
    padding = 0
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 64
        padding += 0 if at & (at - 1) == 0 else 64 - at
    assert padding <= 0.02 * sum(map(len, ids.values())) + 64
    assert packing.pack(nothing, path).count() == 0


def test_packing_ids_are_the_library_s(spark):
    """End marks inside texts, text without white space, and null keys beside keys that no double holds."""
    tokenizers = pytest.importorskip("tokenizers")
    path = P.path("byte_bpe_50k.json")
    tok = tokenizers.Tokenizer.from_file(path)
    mark = "<|endoftext|>"
    big = 2**60
    body = {big + 1: f"one {mark} two", big + 2: mark, big + 3: f"x{mark}{mark}\n y", big + 4: "<|endof text|> <|endoftext |>", big + 5: "日本語の文章" * 300, big + 6: "a" * 3000, None: f"  {mark} nothing keyed"}
    rows = spark.createDataFrame([(k, t, 1, "x") for k, t in body.items()], "doc_id long, text string, start int, uid string")
    out = packing.pack(rows, path, window=64, spare_share=2).collect()
    ids = {k: [*tok.encode(t, add_special_tokens=False).ids, 1] for k, t in body.items()}
    assert 50256 in ids[big + 1] and 50256 not in ids[big + 4]
    for r in out:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
    assert {k: sum(r["length"] for r in out if r["doc_id"] == k) for k in body} == {k: len(v) for k, v in ids.items()}


def test_caches_are_bounded_by_bytes(monkeypatch):
    path = P.path("byte_bpe_50k.json")
    coder = packing.ChunkEncoder(path)
    first = coder.ids(["long" * 500 + " word", "word"])
    assert set(coder.known) == {" word", "word"} and coder.held > 0
    monkeypatch.setattr(packing, "CACHE_BYTES", 1)
    assert [a.tolist() for a in coder.ids(["long" * 500 + " word", "word"])] == [a.tolist() for a in first]
    assert coder.ids([]) == [] and coder.held == 0
    enc = byte_bpe.SegmentTreeBpe(byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    ids = enc.encode("字" * 400 + " word")
    assert max(map(len, [*enc.chunks, *enc.pieces])) <= byte_bpe.LONG_CHUNK and enc.held > 0
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 1)
    assert enc.encode("字" * 400 + " word") == ids


def test_license_scan(spark, nothing):
    rows = [(1, "  MIT  License, mit-license and the General\nPublic license"), (2, None), (3, ""), (4, "Licensed under the Apache License, Version 2.0."), (4, "Licensed under the Apache License, Version 2.0."), (None, "mit licenseé mit license")]
    out = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 6
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out}
    assert got == {1: (9, 3, 0, 6, "gpl,mit"), 2: (0, 0, None, None, ""), 3: (0, 0, None, None, ""), 4: (8, 1, 3, 3, "apache"), None: (4, 1, 2, 2, "mit")}
    assert {r["labels"] for r in out if r["doc_id"] == 4} == {"apache,apache-2.0"} and sum(r["doc_id"] == 4 for r in out) == 2
    assert licenses.scan(nothing).count() == 0


def test_line_dedup(spark, nothing):
    rows = [(i, f"own line {i} of some length\nboiler\n\nlast {i}", f"s{i % 12}") for i in range(30)] + [(99, None, None), (98, "boiler", "s1"), (97, "", "s2")]
    out = {r["doc_id"]: r for r in line_dedup.remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert len(out) == 33 and out[3]["text"] == "own line 3 of some length\n\nlast 3" and out[3]["n_removed"] == 1
    assert out[99]["text"] is None and out[98]["text"] == "boiler" and out[97]["text"] == ""
    assert line_dedup.remove_boilerplate(nothing).count() == 0


def test_line_dedup_of_documents_that_are_mostly_boilerplate(spark):
    passage = "a long passage that stands on many sites " * 5
    rows = [(i, f"{passage}\nown {i}", f"s{i}") for i in range(12)] + [(98, f"{passage}\n \n", "s1"), (99, f"{passage}\n{passage}", "s2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r for r in line_dedup.remove_boilerplate(df).collect()}
    assert all(out[i]["text"] == f"own {i}" and out[i]["n_removed"] == 1 and out[i]["n_lines"] == 2 for i in range(12))
    assert all(out[i]["text"] == rows[i - 86][1] and out[i]["n_removed"] == 0 for i in (98, 99))
    assert {r["n_removed"] for r in line_dedup.remove_boilerplate(df, most_removed=0.5).collect()} == {0}


def test_simhash_against_brute_force(docs, nothing):
    rows = docs.collect()
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == 41 and simhash.near_duplicates(nothing).count() == 0
    fps = [int(r["fingerprint"], 16) for r in out]
    ids = [r["doc_id"] for r in out]
    group = list(range(len(out)))
    for _ in group:
        for a, b in itertools.combinations(range(len(out)), 2):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                group[a] = group[b] = min(group[a], group[b])
    for i, r in enumerate(out):
        assert r["component_id"] == min(ids[j] for j in range(len(out)) if group[j] == group[i])
    assert {r["fingerprint"] for r in out if r["doc_id"] in (6, 7, 9)} == {"0" * 16}
    assert len(rows) == 41


def test_crowded_links(spark):
    rng = random.Random(4)
    base = rng.getrandbits(63)
    near = {base ^ (1 << rng.randrange(60)) ^ (1 << rng.randrange(60)) for _ in range(150)} | {rng.getrandbits(63) for _ in range(50)}
    links = simhash.links_within(spark.createDataFrame([(f,) for f in near], "fp long"), 2, crowded=4)
    got = {frozenset(r) for r in links.distinct().collect()}
    comp = {r["node"]: r["component"] for r in components(links).collect()}
    for a, b in itertools.combinations(near, 2):
        if (a ^ b).bit_count() <= 2:
            assert comp[a] == comp[b]
    assert all((a ^ b).bit_count() <= 2 for a, b in (tuple(g) for g in got))


def test_similar_groups_keep_one(spark, nothing):
    rng = random.Random(7)
    rows = []
    for g in range(6):
        words = [rng.choice(BASE) + str(rng.randrange(50)) for _ in range(300)]
        for c in range(20):
            copy = list(words)
            if c:
                copy[rng.randrange(300)] = f"edit{c}"
            rows.append((g * 100 + c, " ".join(copy)))
    df = spark.createDataFrame(rows + [(900, None), (901, ""), rows[0]], "doc_id long, text string")
    groups = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(df, crowded=4).collect()}
    assert all(groups[i] == i // 100 * 100 for i in groups)
    assert sorted(r["doc_id"] for r in simhash.keep_one(df, simhash.similar_groups(df)).collect()) == [0, 100, 200, 300, 400, 500, 900]
    assert simhash.similar_groups(nothing).count() == 0


def test_parts_are_listed_once(spark, monkeypatch):
    """The joins on crowded and other values read one list of the parts, whatever their number."""
    plans, cut = [], simhash.Stages.cut

    def noted(self, df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return cut(self, df)

    monkeypatch.setattr(simhash.Stages, "cut", noted)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[:i] + [f"edit{i}"] + words[i + 1 :])) for i in range(30)] + [(50 + i, f"other {i} " * 9) for i in range(5)]
    got = simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), crowded=4)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {i: 0 if i < 30 else i for i, _ in rows}
    lists = [line for plan in plans for line in plan.splitlines() if "Generate explode(slots" in line and "group" in line and "q0" in line]
    assert len(lists) == 1


def test_texts_that_share_a_key(spark):
    one, two = (" ".join(f"{name}{i}" for i in range(60)) for name in ("one", "twoä"))
    rows = [(1, one), (1, two), (1, two), (2, one + " more"), (0, two + " more"), (3, None), (3, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.keep_one(df, simhash.similar_groups(df)).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == [(0, two + " more"), (1, one), (3, ""), (3, "other")]


def test_similar_texts_meet_whatever_the_size():
    rng = np.random.default_rng(11)
    for nodes in (4_000, 1_000_000, 300_000_000):
        bits, parts = simhash.layout(nodes, 0.8)
        words, met = simhash.words_needed(nodes, 0.8), 0
        assert bits * parts <= 64 * words and all(simhash.words_needed(n, 0.8) <= words for n in (2, nodes // 3))
        for _ in range(400):
            # 160 common hashes of 180 each: a similarity of exactly 0.8
            pool = rng.integers(0, 2**64, 200, dtype=np.uint64)
            x, y = (sum(v % 2**64 << 64 * i for i, v in enumerate(simhash.wide_fingerprint(h, words))) for h in (pool[:180], pool[20:]))
            met += any(((x ^ y) >> bits * i & (1 << bits) - 1).bit_count() <= 1 for i in range(parts))
        assert met >= 0.97 * 400, nodes


def test_thresholds_of_least_cost():
    rng = random.Random(5)
    gain = [0, 2, 12, 31]
    for _ in range(20):
        cost = [[0.0] + sorted(rng.random() * 100 for _ in range(3)) for _ in range(4)]
        total, chosen = simhash.allocate_for(cost, gain, 48)
        best = min(
            sum(c[t + 1] for c, t in zip(cost, ts)) for ts in itertools.product(range(-1, 3), repeat=4) if sum(gain[t + 1] for t in ts) >= 48
        )
        assert abs(total - best) < 1e-9 and abs(sum(c[t + 1] for c, t in zip(cost, chosen)) - best) < 1e-9
    assert simhash.allocate_for([[0.0, 1.0, 2.0, 3.0]], gain, 48) is None


def test_parts_of_similar_texts(spark):
    """Bits that go together share a part, which so many pairs agree on that it gets less than the others."""
    rng = np.random.default_rng(3)
    bits = rng.integers(0, 2, (4000, 256), dtype=np.uint8)
    alike = list(range(0, 240, 10))
    bits[:, alike] = (rng.random((4000, 1)) < 0.5) ^ (rng.random((4000, len(alike))) < 0.002)
    words = [f"f{w}" for w in range(4)]
    packed = np.packbits(bits, axis=1, bitorder="little").view("<i8")
    df = spark.createDataFrame([tuple(r) for r in packed.tolist()], ", ".join(f"{w} long" for w in words))
    chosen = simhash.choose_similar_parts(df, words, 4000, 0.8)
    width, parts = simhash.layout(4000, 0.8)
    apart = simhash.bits_apart(0.8)
    missed = np.prod([1 - simhash.near_probability(np.full(len(g), apart), 2)[t] for g, t in chosen])
    assert missed <= (1 - simhash.near_probability(np.full(width, apart), 1)[1]) ** parts * (1 + 1e-6)
    used = [b for g, _ in chosen for b in g]
    assert len(used) == len(set(used))
    together = [t for g, t in chosen if len(set(g) & set(alike)) > len(g) // 2]
    assert max(together, default=-1) < max(t for _, t in chosen)
    # the values that the parts are joined on are the bits of the groups
    row = simhash.with_slots(df, words, [(i << 32 | t << 30, g) for i, (g, t) in enumerate(chosen)]).first()
    mine = bits[(packed == [row[w] for w in words]).all(axis=1)][0]
    assert row["slots"] == [(i << 32 | t << 30) + sum(int(mine[b]) << at for at, b in enumerate(g)) for i, (g, t) in enumerate(chosen)]


def test_crowded_values_a_bit_apart(spark, monkeypatch):
    """Two groups, each at one crowded value, a bit apart; the only pair that links them agrees nowhere else."""
    import xxhash
    from pyspark import cloudpickle

    def changed(words, at):
        return [at.get(i, w) for i, w in enumerate(words)]

    def node(t):
        return xxhash.xxh64_intdigest(np.unique(simhash.shingle_hashes(" ".join(t), 5)).tobytes()) - 2**63

    x = [f"w{i}" for i in range(104)]
    y = changed(x, {20: "left", 35: "right"})
    groups = []
    for name, head in (("a", x), ("b", y)):
        # the group's leader is its smallest node, and not the one that the pair has
        spare = [c for c in (changed(head, {60 + 10 * (name == "b"): f"{name}{i}"}) for i in range(60)) if node(c) < node(head)]
        others = [c for c in (changed(head, {60 + 10 * (name == "b"): f"{name}{i}"}) for i in range(60, 67))]
        groups.append([head, spare[0], *others])
    mine = random.Random(3).getrandbits(252)
    yours = mine ^ 1
    for part in range(1, 21):
        yours ^= 3 << 12 * part
    prints = {}
    for group, value in zip(groups, (mine, yours)):
        for t in group:
            prints[np.unique(simhash.shingle_hashes(" ".join(t), 5)).tobytes()] = np.array([value >> 64 * i & 2**64 - 1 for i in range(4)], dtype="<u8").view("<i8").tolist()
    monkeypatch.setattr(simhash, "wide_fingerprint", lambda hashes, words=4: prints[hashes.tobytes()])
    cloudpickle.register_pickle_by_value(simhash)
    try:
        df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(groups[0] + groups[1])], "doc_id long, text string")
        got = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(df, crowded=4, leaders=1).collect()}
    finally:
        cloudpickle.unregister_pickle_by_value(simhash)
    assert len(got) == 18 and set(got.values()) == {0}


def test_bottom_k(docs, nothing):
    out = {r["doc_id"]: r for r in bottom_k.edited_likeness(docs, ranges=3).collect()}
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    for i, (key, t) in enumerate(rows):
        m = len(t) // 4
        follow = rows[(i + 1) % len(rows)]
        if key != 3:
            assert out[key]["edited_sha256"] == hashlib.sha256((t[: len(t) - m] + follow[1][:m]).encode()).hexdigest()
    assert out[4]["fingerprint"] == out[5]["fingerprint"] and out[4]["near_next"] == 1.0 and out[7]["fingerprint"] == ""
    assert bottom_k.edited_likeness(nothing).count() == 0
    merged = bottom_k.merge(bottom_k.document_sketches(docs).withColumn("all", bottom_k.F.lit(1)), ["all"]).first()["sketch"]
    every = sorted({h for r in bottom_k.document_sketches(docs).collect() for h in r["sketch"]})
    assert merged == every[: bottom_k.K]


def test_toxicity_learns_from_documents(spark):
    rng = random.Random(9)
    bad = ["grobian", "schuft", "lumpen"]
    rows, labels = [], []
    for i in range(600):
        sents = [" ".join(rng.choice(BASE) for _ in range(8)) for _ in range(6)]
        toxic = i % 3 == 0
        if toxic:
            sents[rng.randrange(6)] += " " + rng.choice(bad)
        rows.append((i, ". ".join(sents)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows + [(1000, None), (1001, "")], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, marks.filter(~toxicity.held_out()))
    out = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [(i, y) for i, y in labels if toxicity.is_held_out(i)]
    assert sum(out[i]["predicted"] == y for i, y in held) / len(held) > 0.97
    assert out[1000]["score"] == out[1001]["score"] == 0.0
    hit = next(i for i, y in held if y and out[i]["predicted"])
    assert any(b in out[hit]["worst_sentence"] for b in bad)
    assert toxicity.train(docs, marks.filter("toxic = 1")).weights == {}
    kept = {r["doc_id"] for r in toxicity.keep_clean(docs, model).collect()}
    assert kept == {i for i in out if not out[i]["predicted"]}


def best_rows(held, asked, k):
    """Scores and keys of the best rows of each distinct query, by comparing it with every row."""
    return sorted((i, tuple(sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in held if j != i)[:k])) for i, v in {(i, tuple(v)) for i, v in asked})


def answers(out, k):
    """The answers in the same form; queries of one key with several vectors are told apart by their ranks."""
    rows = sorted((r["query_id"], r["rank"], -r["score"], r["vec_id"]) for r in out.collect())
    return {q: [tuple(r[2:]) for r in rows if r[0] == q] for q in {r[0] for r in rows}}


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)] + [(300, None), (301, [1.0, None] + [0.0] * 6), (302, [float("nan")] * 8), (303, [0.0] * 8), (7, [0.5] * 8), (340, [0.25] * 5), (None, [1.0] * 8)]
    # ties: whole-number vectors of few values, one of them many times, and a query that scores 0 everywhere
    rows += [(1000 + i, [float(i % 3 - 1), float(i % 2)] + [0.0] * 6) for i in range(150)] + [(2000, [0.0] * 8), (2001, [1.0] * 8), (2001, [1.0] * 8)]
    frame = spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<double>, key string")
    vectors = topk.integer_vectors(frame)
    held = [(r["key"], r["v"]) for r in vectors.collect()]
    asked = [(i, v) for i, v in held if i % 20 == 0]
    for sizes in ({"block_rows": 64, "group_queries": 4, "stripe_rows": 100}, {"block_rows": 16, "group_queries": 1000}, {}):
        got = answers(topk.top_k(vectors.filter("key % 20 = 0"), vectors, k=5, **sizes), 5)
        assert sorted((q, tuple(a)) for q, a in got.items()) == best_rows(held, asked, 5)
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0
    assert topk.top_k(vectors.filter("key = 20"), vectors.limit(0)).count() == 0
    assert topk.top_k(vectors.filter("key = 20"), vectors.filter("key = 20")).count() == 0
    assert topk.top_k(vectors.filter("key = 20"), vectors, k=10_000).count() == sum(i != 20 for i, _ in held)


def test_top_k_of_queries_that_share_a_key(spark):
    rows = spark.createDataFrame([(1, [1, 0]), (1, [0, 1]), (1, [0, 1]), (2, [5, 0]), (3, [0, 7]), (4, [1, 1])], "key long, v array<long>")
    got = topk.top_k(rows.filter("key = 1"), rows, k=2).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == [(1, 2, 5), (1, 3, 7), (2, 4, 1), (2, 4, 1)]


def test_top_k_scores_are_integers_of_any_size(spark):
    for size in (2**26, 2**30, 2**40):
        # neighbouring scores differ by 1 where doubles would not tell them apart
        rows = [(i, [size, size + i % 7, i]) for i in range(60)] + [(60, [1, 1, 0]), (80, [size // 2**10, -size, 1])]
        frame = spark.createDataFrame(rows, "key long, v array<long>")
        asked = [r for r in rows if r[0] in ((60,) if size == 2**40 else (20, 60, 80))]
        got = answers(topk.top_k(frame.filter(f"key in ({','.join(str(i) for i, _ in asked)})"), frame, k=9, block_rows=8), 9)
        assert sorted((q, tuple(a)) for q, a in got.items()) == best_rows(rows, asked, 9)
    wide = spark.createDataFrame([(20, [2**40]), (21, [2**40])], "key long, v array<long>")
    with pytest.raises(Exception, match="(?i)int|large"):
        topk.top_k(wide.filter("key = 20"), wide).collect()
    with pytest.raises(Exception, match="64 bits"):
        topk.integer_vectors(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>")).collect()


def test_queries_stop_at_their_bound():
    """Where one component decides, the lists are read no further than needed; a kth score of an earlier block ends a later one at once."""
    rng = np.random.default_rng(4)
    rows = np.floor(rng.normal(size=(4000, 6)) * np.array([400, 4, 4, 2, 2, 2]))
    asks = topk.TopK(np.array([-1, -2]), np.array([[9.0, 1, 0, 0, 0, 0], [-9.0, 0, 1, 0, 0, 0]]), 5)
    assert asks.search(topk.SortedLists(np.arange(4000), rows)) < 4000
    assert asks.search(topk.SortedLists(np.arange(4000, 8000), rows // 4)) < 400
    for q in range(2):
        scores = rows @ asks.vectors[q]
        assert asks.found[q].tolist() == np.lexsort((np.arange(4000), -scores))[:5].tolist()


def test_stupid_backoff_against_counts(docs, nothing):
    out = {r["doc_id"]: r for r in ngram_lm.score(docs, order=3, batch_chars=500, table_rows=50).collect()}
    ws = [(r["doc_id"], (r["text"] or "").lower().split()) for r in docs.collect()]
    from collections import Counter

    n = [Counter(tuple(w[i : i + k]) for _, w in ws for i in range(len(w) - k + 1)) for k in (1, 2, 3)]
    total = sum(n[0].values())

    def word(w, i):
        for k in (3, 2):
            if i >= k - 1 and n[k - 1][tuple(w[i - k + 1 : i + 1])] >= 2:
                return np.log(n[k - 1][tuple(w[i - k + 1 : i + 1])] / n[k - 2][tuple(w[i - k + 1 : i])]) + np.log(0.4) * (min(i, 2) + 1 - k)
        return np.log(n[0][(w[i],)] / total) + np.log(0.4) * min(i, 2)

    for key, w in ws:
        assert out[key]["log_score"] == pytest.approx(sum(word(w, i) for i in range(len(w)))) and out[key]["n_words"] == len(w)
    assert out[7]["mean_log_score"] is None and ngram_lm.score(nothing).count() == 0


def test_three_words_are_scored(spark):
    from collections import Counter

    from stokesweave.llm.queries import QUERIES

    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 5000):
        keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (ngram_lm.unpack_keys(ngram_lm.pack_keys(keys)) == keys).all()
    folder = "/root/testdata/sf0.001"
    ws = {r["doc_id"]: re.findall("[^ \\t\\n\\x0b\\f\\r]+", re.sub("[A-Z]+", lambda m: m[0].lower(), r["text"] or "")) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    n = [Counter(tuple(w[i : i + k]) for w in ws.values() for i in range(len(w) - k + 1)) for k in (1, 2, 3)]
    total = sum(n[0].values())

    def word(w, i):
        for k in (3, 2):
            if i >= k - 1 and n[k - 1][tuple(w[i - k + 1 : i + 1])] >= 2:
                return np.log(n[k - 1][tuple(w[i - k + 1 : i + 1])] / n[k - 2][tuple(w[i - k + 1 : i])]) + np.log(0.4) * (min(i, 2) + 1 - k)
        return np.log(n[0][(w[i],)] / total) + np.log(0.4) * min(i, 2)

    for r in QUERIES["lm_scoring_three_words"](spark, folder).collect():
        w = ws[r["doc_id"]]
        assert r["n_words"] == len(w) and r["log_score"] == pytest.approx(sum(word(w, i) for i in range(len(w))), abs=1e-3)


def test_pipeline_on_the_smallest_tables(spark):
    import corpus_pipeline as C

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    total = docs.count()
    for name, stage in C.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns
        after = spark.createDataFrame(after.collect(), docs.schema)
        assert total * 0.5 < after.count() <= docs.count(), name
        docs = after
    packed = C.STAGES[-1][1](spark, docs, folder).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}
    assert re.match("toxicity", C.STAGES[0][0])
