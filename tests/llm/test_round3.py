"""Source divergence, conversation repair and language identification against brute force and held-out accuracy."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

from stokesweave.llm import conversations, divergence, language_id  # noqa: E402

# --- source divergence ---------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n string, place string, value string"


def divergence_by_hand(rows, least, best):
    docs = [((lang or ""), (source or ""), TERM.findall((text or "").translate(FOLD))) for lang, source, text in rows]
    held, out = defaultdict(Counter), []
    for lang, _, terms in docs:
        held[lang].update(set(terms))
    for lang in {d[0] for d in docs}:
        kept = [t for t, n in held[lang].items() if n >= least]
        groups = {s for g, s, _ in docs if g == lang}
        counts = {s: Counter(t for g, q, terms in docs if (g, q) == (lang, s) for t in terms) for s in groups}
        counts[None] = sum(counts.values(), Counter())
        p = {}
        for s, c in counts.items():
            total = sum(c[t] for t in kept) + 5 * len(kept)
            p[s] = {t: 1 + 1_000_000_000 * (c[t] + 5) // total for t in kept}
        for s in groups:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, p[s][t] - p[None][t]) for t in kept if counts[s][t] > 0 and p[s][t] > p[None][t]]
            for part, items, top in (("pair", pairs, None), ("term", terms, best)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:top]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(items, 1)]
    return sorted(out)


def divergence_rows(n=90, seed=3):
    rng = random.Random(seed)
    words = [w + e for w in ("Da", "le", "ñu", "tion", "日本", "Éa", "x") for e in ("", "n", "Re", "ß")]
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "en", "fr", None, ""])
        text = rng.choice([" ", "-", "7", "\n"]).join(rng.choice(words) for _ in range(rng.randint(0, 40)))
        rows.append((lang, rng.choice(["a", "b", "c", "d", "Ä", None]), rng.choice([text, text, text, None, ""])))
    rows += [("de", "only", "ein Wort"), ("it", "a", "una parola"), ("it", "b", None)] + [("en", "a", "da den " * 30_000)] + rows[:6]
    return rows


@pytest.mark.parametrize(("tile", "block"), [(32, 4096), (2, 8)])
def test_divergence_equals_brute_force(spark, monkeypatch, tile, block):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "BLOCK", block)
    rows = divergence_rows()
    df = spark.createDataFrame([(i, t, lang, s, "clash", "clash", "clash") for i, (lang, s, t) in enumerate(rows)], DOCS)
    got = sorted(map(tuple, divergence.audit(df, least=4, best=5).collect()))
    assert got == divergence_by_hand(rows, 4, 5)


def test_divergence_names_a_pair_alike_in_every_block():
    # a shuffle brings the rows of one block in another order than those of the next
    heads = [(s, -1, 20) for s in ("b", "ü", "a", "")]
    cells = [("b", 0, 3), ("a", 0, 1), ("", 0, 2), (None, -1, 30), (None, 0, 6)]
    key = ("en", 0, 0, 0)
    named = []
    for block, rows in enumerate([heads + cells, (heads + cells)[::-1]]):
        table = pa.table(
            {"source": pa.array([r[0] for r in rows], pa.string()), "tile": [0] * len(rows), "place": pa.array([r[1] for r in rows], pa.int32()), "n": [r[2] for r in rows], "width": pa.array([1] * len(rows), pa.int32())}
        )
        out = divergence._price_block(5)(tuple(pa.scalar(k) for k in (key[0], block, *key[2:])), table).to_pylist()
        named.append(sorted((r["kind"], r["source"], r["other"] or "", r["value"]) for r in out))
    assert named[0] == named[1]
    assert len({(r[1], r[2]) for r in named[0] if r[0] == 0}) == 6


def test_divergence_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).collect() == []


def test_trees_share_nodes_and_price_pairs_once():
    rng = np.random.default_rng(1)
    counts = rng.poisson(0.4, (12, 1024))
    counts[:, :40] = rng.integers(0, 500, (12, 40))
    counts[:, 1000:] = divergence.ABSENT
    forest = divergence.Forest(counts)
    assert sum(forest.sizes) < 0.2 * counts.size * 2
    prices = divergence._prices(forest, [int(c[c > 0].sum()) + 5000 for c in counts])
    a, b = np.triu_indices(12, 1)
    own = np.take_along_axis(prices, np.searchsorted(forest.values, counts), axis=1)
    assert (divergence.distances(forest, prices, a, b, at_once=7) == np.abs(own[a] - own[b]).sum(axis=1)).all()
    assert divergence.Walk(forest, a, b).opened < 0.5 * len(a) * 2 * 1024


def test_shares_are_exact_for_large_counts():
    rng = random.Random(2)
    for top in (10**3, 10**12, 10**15, 10**17, 4 * 10**18):
        counts = [rng.randrange(top) for _ in range(50)] + [0, top - 6]
        total = top + 5 * len(counts)
        assert divergence.shares(np.array(counts), total).tolist() == [1 + 1_000_000_000 * (c + 5) // total for c in counts]


def test_terms_of_long_texts():
    text = ("Wort" * 700_000 + " ab-c " + "ñ x" * 600_000 + "z" * 10).encode()
    whole = TERM.findall(text.decode().translate(FOLD))
    assert [t.decode() for part in divergence.term_lists(text) for t in part] == whole


# --- conversation repair ---------------------------------------------------------

SPACE = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """Cost and audit of the cheapest edits of (role, fault) rows, ASCII-least: every choice at every place."""
    memo = {}

    def best(k, state, inserted):
        if (k, state, inserted) not in memo:
            ways = []
            if k == len(rows) and state in ("", "a"):
                ways.append((0, ""))
            if inserted < 4:
                c, a = best(k, NEXT[state], inserted + 1)
                ways.append((c + 5, "I" + a))
            if k < len(rows):
                role, fault = rows[k]
                c, a = best(k + 1, state, 0)
                ways.append((c + 2, "D" + a))
                if fault not in ("blank", "duplicate"):
                    extra = 5 if fault == "truncated" else 0
                    c, a = best(k + 1, NEXT[state], 0)
                    ways.append((c + 1 + extra, "R" + a))
                    first = role[:1]
                    if first == NEXT[state] or (first == "s" and state == ""):
                        c, a = best(k + 1, first, 0)
                        ways.append((c + extra, "K" + a))
            memo[k, state, inserted] = min(ways) if ways else (10**9, "")
        return memo[k, state, inserted]

    return best(0, "", 0)


def repair_by_hand(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        damaged = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            name = ":".join(" " if v is None else str(v) for v in (conv, turn))
            role, text = " " if role is None else role, " " if text is None else text
            fault = zlib.crc32(name.encode()) % 20
            if fault == 0:
                continue
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            role = "user" if fault == 4 else role
            damaged += [(turn, role, text)] * (2 if fault == 3 else 1)
        damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in damaged:
            body = text.rstrip(SPACE)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = {r[0] for r in damaged} - {None}
        cost, audit = cheapest([(r[1], f) for r, f in zip(damaged, faults)])
        lines, state, k = [], "", 0
        for edit in audit:
            if edit in "IR":
                state = NEXT[state]
                lines.append({"u": "user", "a": "assistant"}[state] + ":" + ("" if edit == "I" else damaged[k][2]))
            elif edit == "K":
                state = damaged[k][1][0]
                lines.append(f"{damaged[k][1]}:{damaged[k][2]}")
            k += edit != "I"
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(damaged)),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def conversation_rows(seed=5):
    rng = random.Random(seed)
    said = ["Yes.", "No", "Why?", "", " \t", None, "Ok.", "Né !  ", "x" * 20_000 + ".", "\u00a0", "日本。"]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.choice([1, 2, 5, 9, 40])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            role = role if rng.random() < 0.4 else "ua"[turn % 2] and ("user", "assistant")[turn % 2]
            turn = rng.choice([turn, turn, turn, turn + 3, None])
            rows.append((conv, turn, role, f"{rng.random()}." if rng.random() < 0.5 else rng.choice(said)))
    # a conversation whose only row is dropped
    lone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(lone, 0, "user", "gone.")] + rows[10:30] + [(77, 4, "assistant", "Again.")] * 50


TALKS = "conv_id long, turn long, role string, text string, kind string, at string, copies string"


@pytest.mark.parametrize("piece", [4096, 3])
def test_repair_equals_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE", piece)
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], TALKS)
    got = conversations.repair(df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = got.collect()
    want = repair_by_hand(rows)
    assert len(got) == len(want)
    assert {r[0]: tuple(r[1:]) for r in got} == want


def test_repair_of_nothing(spark):
    assert conversations.repair(spark.createDataFrame([], TALKS)).collect() == []


def test_halves_give_the_least_audit():
    rng = random.Random(9)
    names = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    faults = {"-": None, "b": "blank", "d": "duplicate", "t": "truncated"}
    for _ in range(1500):
        rows = [(rng.choice("suao" if rng.random() < 0.3 else "ua"), rng.choice("----bdt")) for _ in range(rng.randint(1, 14))]
        kinds = "".join(conversations.KINDS[r] for r in rows)
        cuts = sorted(rng.sample(range(1, len(rows)), rng.randint(0, min(3, len(rows) - 1)))) if len(rows) > 1 else []
        runs = [kinds[a:b] for a, b in itertools.pairwise([0, *cuts, len(kinds)])]
        cost, borders = conversations.chain([conversations.matrix(k) for k in runs])
        audit = "".join(conversations.between(k, s, t) for k, (s, t) in zip(runs, itertools.pairwise(borders))) + conversations.ENDING[borders[-1]][1]
        assert (cost, audit) == cheapest([(names[i], faults[f]) for i, f in rows])


# --- language identification -----------------------------------------------------

VOICES = {
    "en": "the of and to that with thing shore blend house water other thought wind night".split(),
    "de": "der die und nicht schön zwischen straße wasser haus licht über kein auch noch wenig".split(),
    "fr": "le les des une être château eau maison où très avec pour dans chez jour".split(),
    "ru": "и не что дом вода ночь свет ветер слово время очень быть когда город река".split(),
    "ja": ["これは水です", "夜の町", "言葉と時間", "かぜがふく", "ひかり"],
}


def speech(rng, lang, n):
    return " ".join(rng.choice(VOICES[lang]) for _ in range(n)).capitalize() + "."


PAGES = "doc_id long, text string, lang string, source string, score string, lang_pred string, spans string, key string"


@pytest.fixture(scope="module")
def speakers(spark):
    rng = random.Random(4)
    rows = []
    for k in range(600):
        lang = rng.choice(list(VOICES))
        rows.append((k, speech(rng, lang, rng.randint(4, 60)), lang))
    # held-out rows carry wrong labels: learning from them would show
    wrong = [(k, t, rng.choice(list(VOICES)) if zlib.crc32(str(k).encode()) % 4 == 2 else lang) for k, t, lang in rows]
    wrong += [(None, "der die und", "xx"), (9001, None, "en"), (9002, "", "de"), (9003, "der die", None)]
    df = spark.createDataFrame([(*r, "c", "c", "c", "c", "c") for r in wrong], PAGES)
    return rows, language_id.train(df)


def answers(spark, model, texts, **more):
    df = spark.createDataFrame([(k, t, "zz", "c", "c", "c", "c", "c") for k, t in enumerate(texts)], PAGES)
    return {r["doc_id"]: r for r in language_id.identify(df, model, **more).collect()}


def test_language_of_held_out_texts(spark, speakers):
    rows, model = speakers
    assert model.langs == sorted(VOICES)
    kept = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    found = answers(spark, model, [r[1] for r in kept])
    assert np.mean([found[k]["lang_pred"] == r[2] for k, r in enumerate(kept)]) >= 0.99
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_spans_of_mixed_texts(spark, speakers):
    rng = random.Random(8)
    for _ in range(5):
        parts = [speech(rng, lang, 30) for lang in ("en", "fr", "ru", "de")]
        text = "\n".join(parts)
        got = answers(spark, speakers[1], [text])[0]["spans"]
        assert [s["lang"] for s in got] == ["en", "fr", "ru", "de"]
        for part, s in zip(parts, got):
            assert abs(text.index(part) - s["start"]) <= 12 and abs(len(part) - s["length"]) <= 24


def test_odd_texts(spark, speakers):
    long = speech(random.Random(1), "de", 150_000)
    texts = [None, "", " 12 – ½ _ …", "\u0301", "Ωμέγα και άλφα", "the", long, long, "x" * 100_000, "noch ḱ", "水水水水", "the der " * 400]
    got = answers(spark, speakers[1], texts)
    assert [(got[k]["lang_pred"], got[k]["score"], got[k]["spans"]) for k in range(4)] == [("und", 0.0, [])] * 4
    assert got[4]["lang_pred"] in VOICES and got[4]["score"] < 0.5
    assert got[5]["lang_pred"] == "en" and got[6] [1:] == got[7][1:] and got[6]["lang_pred"] == "de"
    assert got[10]["lang_pred"] == "ja"
    again = answers(spark, speakers[1], texts, spans=False, block=1)
    assert {k: r[1:3] for k, r in again.items()} == {k: r[1:3] for k, r in got.items()}


def test_language_of_nothing(spark, speakers):
    empty = spark.createDataFrame([], PAGES)
    assert language_id.identify(empty, speakers[1]).collect() == []
    blank = language_id.train(empty)
    assert [r["lang_pred"] for r in answers(spark, blank, ["the der", None]).values()] == ["und", "und"]


def test_viterbi_equals_every_labelling():
    rng = np.random.default_rng(6)
    scores = rng.normal(0, 2, (30, 3)).astype(np.float32)
    words = [rng.integers(0, 30, n) for n in (0, 1, 6, 3, 5, 6, 2)]
    start = np.log(np.array([0.5, 0.3, 0.2]))
    for w, got in zip(words, language_id.viterbi(words, scores, start, 1.5)):
        if not len(w):
            assert not len(got)
            continue

        def value(y):
            return start[y[0]] + sum(scores[a, b] for a, b in zip(w, y)) - 1.5 * sum(a != b for a, b in itertools.pairwise(y))

        assert value(got) == pytest.approx(max(value(y) for y in itertools.product(range(3), repeat=len(w))), abs=1e-4)


def test_letter_probabilities_sum_to_one(speakers):
    model = speakers[1]
    for before in ("\n\n", "\nd", "ch", "zz", "qu"):
        letters = [g for g in model.rows if len(g) == 1 and g != "-"]
        sums = np.zeros(len(model.langs))
        for c in letters:
            out, rows = np.zeros(len(model.langs)), model.rows
            g = before + c
            for k in range(3):
                if g[k:] in rows:
                    out += model.table[rows[g[k:]]]
                    break
                left = rows.get("-" + g[k:2])
                if left is not None:
                    out += model.table[left]
            sums += np.exp(out)
        assert (sums <= 1 + 1e-9).all() and (sums > 0.6).all()
