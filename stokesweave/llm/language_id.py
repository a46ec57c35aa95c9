"""Language identification of mixed-language text.

A text is read as words, each a run of letters of one script.  The script narrows a word to the languages that are written
in it; among these a word scores by its frequency in the language, mixed with a model of its letters given the two before.  A Viterbi
pass labels every word, paying a penalty wherever the language changes, so short foreign words do not break a span and real
passages in another language do.  A text's language is the one whose spans hold most letters.

The model is fitted on a bounded sample, counted by Spark; texts are labelled in blocks, all of a block one word further per step.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stokesweave.llm.common import pieces_of, text_of
from stokesweave.llm.toxicity import held_out

#: scripts and the code points of their letters and marks, fixed values of the Unicode standard
SCRIPTS = {
    "latin": "A-Za-zªºÀ-ÖØ-öø-ɏ̀-ͯḀ-ỿ",
    "greek": "Ͱ-ͳͶ-ͽͿ-ΆΈ-Ͽἀ-῿",
    "cyrillic": "Ѐ-ԯ",
    "armenian": "Ա-Ֆա-և",
    "hebrew": "ְ-ֽא-ת",
    "arabic": "ؠ-ٟٮ-ۓۺ-ۿݐ-ݿ",
    "devanagari": "ऀ-ॣॱ-ॿ",
    "bengali": "ঀ-ৣৰ-ৱ",
    "tamil": "ஂ-ௗ",
    "telugu": "ఀ-ౣ",
    "thai": "ก-ฺเ-๎",
    "georgian": "Ⴀ-ჿ",
    "hangul": "ᄀ-ᇿ㄰-㆏가-힣",
    "kana": "ぁ-ゟァ-ヿ",
    "han": "㐀-䶿一-鿿\U00020000-\U0002a6df",
}
UNSPACED = {"thai", "kana", "han"}  # written without spaces: cut into short pieces
OTHER = "other"
LONGEST, LONGEST_UNSPACED = 40, 6
# a word begins with a letter; where none stands, no script is tried
WORD = re.compile(r"(?=[^\W\d_])(?:" + "|".join([f"[{ranges}]{{1,{LONGEST_UNSPACED if s in UNSPACED else LONGEST}}}" for s, ranges in SCRIPTS.items()] + [rf"[^\W\d_]{{1,{LONGEST}}}"]) + ")")
SCRIPT_OF = [(s, re.compile(f"[{ranges}]")) for s, ranges in SCRIPTS.items()]
EDGE = "\n"  # stands before and after a word
PULL = 2.0  # weight of the shorter context's estimate, in observations
COMMON = 5  # occurrences in the sample from which a word has a score of its own
WORST = 12.0  # no single word tells more than this many nats
SWITCH = 8.0  # nats that a change of language costs
USED = 0.01  # share of a language's letters from which a script counts as its own
SHORT = 1 << 20  # code points of a text whose words are listed at once
TABLE = 200_000  # words whose scores a worker keeps between blocks


def script_of(word: str) -> str:
    return next((s for s, chars in SCRIPT_OF if chars.match(word)), OTHER)


def grams(word: str) -> list[str]:
    """Each letter of a word, and its end, with the two before."""
    padded = f"{EDGE}{EDGE}{word}{EDGE}"
    return [padded[k : k + 3] for k in range(len(padded) - 2)]


# --- model -----------------------------------------------------------------------


@dataclass
class Model:
    """Log probabilities by language: of words, and of letters after two, one and no letters."""

    langs: list[str]
    prior: np.ndarray
    words: dict[str, np.ndarray]
    rows: dict[str, int]
    table: np.ndarray
    scripts: dict[str, np.ndarray]

    def letter_rows(self, word: str) -> list[int]:
        """Rows of ``table`` whose sum is the log probability of the word's letters."""
        out, rows = [], self.rows
        for g in grams(word):
            if g in rows:
                out.append(rows[g])
                continue
            for k in (1, 2):  # a context that was seen without this letter gives the share it leaves to others
                left = rows.get("-" + g[k - 1 : 2])
                if left is not None:
                    out.append(left)
                if g[k:] in rows:
                    out.append(rows[g[k:]])
                    break
            else:
                out.append(rows[""])
        return out

    def scores(self, words: list[str]) -> np.ndarray:
        """Evidence of each word: log probability by language, less the best, never under ``-WORST``."""
        if not words or not self.langs:
            return np.zeros((len(words), len(self.langs)), np.float32)
        lowered, get, rows = [w.lower() for w in words], self.rows.get, []
        for w in lowered:
            found = [get(g) for g in grams(w)]
            rows.append(self.letter_rows(w) if None in found else found)
        starts = np.cumsum([0] + [len(r) for r in rows[:-1]])
        out = np.add.reduceat(self.table[list(chain.from_iterable(rows))], starts, axis=0)
        named = [(k, own) for k, w in enumerate(lowered) if (own := self.words.get(w)) is not None]
        if named:
            at = [k for k, _ in named]
            out[at] = np.logaddexp(out[at], np.array([own for _, own in named])) - np.log(2)
        written = np.array([script_of(w) for w in words])
        for script in np.unique(written):
            at = written == script
            allowed = self.scripts.get(str(script))
            out[at] = 0 if allowed is None else np.where(allowed, out[at], -np.inf)
        return np.maximum(out - out.max(axis=1, keepdims=True), -WORST).astype(np.float32)


def build(letters: dict[str, Counter], words: dict[str, Counter], documents: dict[str, int]) -> Model:
    """A model from counts of :func:`grams` and of words by language."""
    langs = sorted(letters)
    n = len(langs)
    counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(n))
    own: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(n))
    for k, lang in enumerate(langs):
        for g, c in letters[lang].items():
            for part in (g, g[1:], g[2:], "-" + g[:2], "-" + g[1:2], "-"):
                counts[part][k] += c
            if g[2] != EDGE:
                own[script_of(g[2])][k] += c
    alphabet = sum(len(g) == 1 and g != "-" for g in counts) + 1
    prob: dict[str, np.ndarray] = {"": 1.0 / (counts["-"] + alphabet)} if n else {}
    for length in (1, 2, 3):
        for g in [g for g in counts if len(g) == length and g[0] != "-"]:
            if length == 1:
                prob[g] = (counts[g] + 1) / (counts["-"] + alphabet)
            else:
                prob[g] = (counts[g] + PULL * prob[g[1:]]) / (counts["-" + g[:-1]] + PULL)
    for g in [g for g in counts if g[0] == "-" and len(g) > 1]:
        prob[g] = PULL / (counts[g] + PULL)
    rows = {g: k for k, g in enumerate(prob)}
    table = np.log(np.array(list(prob.values()))) if prob else np.zeros((0, n))
    total = np.array([max(1, sum(words[lang].values())) for lang in langs], dtype=float)
    common = {w for lang in langs for w, c in words[lang].items() if c >= COMMON}
    with np.errstate(divide="ignore"):
        named = {w: np.log(np.array([words[lang][w] for lang in langs]) / total) for w in common}
    sums = sum(own.values(), np.zeros(n))
    share = np.array([max(1, documents.get(lang, 1)) for lang in langs], dtype=float)
    scripts = {s: c >= USED * np.maximum(sums, 1) for s, c in own.items()}
    return Model(langs, np.log(share / share.sum()) if n else share, named, rows, table, {s: m for s, m in scripts.items() if m.any()})


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words by language; the letters follow from them."""
    held: dict[str, Counter] = defaultdict(Counter)

    def rows() -> pa.RecordBatch:
        flat = [(lang, w, c) for lang, words in held.items() for w, c in words.items()]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat) if flat else ((), (), ()), (pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"])

    for batch in pieces_of(batches):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = (m.group().lower() for m in WORD.finditer(text))
            while part := list(islice(words, 100_000)):
                held[lang].update(part)
        if sum(map(len, held.values())) > 200_000:
            yield rows()
    yield rows()


def _gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces_of(batches, 50_000):
        held: dict[tuple[str, str], int] = defaultdict(int)
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            for g in grams(word):
                held[lang, g] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["lang", "word", "n"]
        )


def train(docs: DataFrame, per_lang: int = 2000, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fit on a bounded sample: of each language the rows outside the held-out fold whose key's hash is among the first
    ``per_lang`` in as many as the language has, so about that many.

    The share is taken from a count of keys and languages; texts are then read in place, whole, and counted by Spark, so nothing is
    sorted, joined or shuffled but counts.  What reaches the driver are the languages, the sample's distinct letter triples and its words of ``COMMON`` or more
    occurrences.  Rows with a null key, text or language teach nothing.
    """
    marked = docs.where(~held_out(key, 4, 2) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    marked = marked.select(F.xxhash64(key).alias("hash"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    documents = {r["lang"]: r["n"] for r in marked.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not documents:
        return build({}, {}, {})
    share = F.create_map(*[F.lit(v) for name, n in documents.items() for v in (name, min(1.0, per_lang / n))])
    texts = marked.where(F.pmod("hash", F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30)).select("lang", "text")
    words = texts.mapInArrow(_count_batches, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    triples = words.mapInArrow(_gram_batches, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    both = words.where(F.col("n") >= COMMON).withColumn("whole", F.lit(True)).unionByName(triples.withColumn("whole", F.lit(False)))
    counts: dict[bool, dict[str, Counter]] = {True: defaultdict(Counter), False: defaultdict(Counter)}
    for r in both.toLocalIterator():
        counts[r["whole"]][r["lang"]][r["word"]] = r["n"]
    return build(counts[False], counts[True], documents)


# --- labelling -------------------------------------------------------------------


class Table(dict):
    """Number of every word met, with its scores and letters."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model, self.new = model, []
        self.scores = np.zeros((0, len(model.langs)), np.float32)
        self.letters = np.zeros(0, np.int64)

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n

    def settle(self) -> None:
        """Score the words met since the last call."""
        for at in range(0, len(self.new), 20_000):
            part = self.new[at : at + 20_000]
            self.scores = np.concatenate([self.scores, self.model.scores(part)])
            self.letters = np.concatenate([self.letters, [sum(c.isalpha() for c in w) for w in part]])
        self.new = []


def viterbi(words: list[np.ndarray], scores: np.ndarray, start: np.ndarray, switch: float) -> list[np.ndarray]:
    """The best language of every word of every text, all texts a word further per step.

    A path into language j comes from j itself or, for the penalty, from the best language before; ties stay.
    """
    order = sorted(range(len(words)), key=lambda k: -len(words[k]))
    lengths = np.array([len(words[k]) for k in order])
    out: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
    if not len(lengths) or not lengths[0]:
        return out
    live = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # texts longer than t
    first = np.concatenate([[0], np.cumsum(live)])
    ids = np.empty(first[-1], np.int32)  # word t of all live texts, then word t + 1
    for k, n in enumerate(order):
        ids[first[: lengths[k]] + k] = words[n]
    moved = np.zeros((len(ids), scores.shape[1]), bool)
    came = np.zeros(len(ids), np.int32)
    state = np.repeat(start[None, :].astype(np.float32), len(order), axis=0)
    for t in range(lengths[0]):
        n, rows = live[t], slice(first[t], first[t + 1])
        now = state[:n]
        if t:
            best = now.argmax(axis=1)
            jump = now[np.arange(n), best] - switch
            move = jump[:, None] > now
            moved[rows], came[rows] = move, best
            now = np.where(move, jump[:, None], now)
        state[:n] = now + scores[ids[rows]]
    end = state.argmax(axis=1)
    labels = np.empty(len(ids), np.int32)
    for t in range(lengths[0] - 1, -1, -1):
        n, rows = live[t], slice(first[t], first[t + 1])
        labels[rows] = end[:n]
        back = moved[rows][np.arange(n), end[:n]]
        end[:n] = np.where(back, came[rows], end[:n])
    for k, n in enumerate(order):
        out[n] = labels[first[: lengths[k]] + k]
    return out


def word_numbers(text: str, table: Table, places: list | None = None) -> np.ndarray:
    """Numbers of a text's words; their first and last code points go to ``places``."""
    if places is None and len(text) <= SHORT:
        words = WORD.findall(text)
        return np.fromiter(map(table.__getitem__, words), np.int32, len(words))
    found, parts = WORD.finditer(text), []
    while part := list(islice(found, 50_000)):
        parts.append(np.fromiter((table[m.group()] for m in part), np.int32, len(part)))
        if places is not None:
            places.extend(m.span() for m in part)
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def judge(words: np.ndarray, labels: np.ndarray, table: Table, prior: np.ndarray) -> tuple[int | None, float]:
    """The language whose words hold most letters, and a score: the share of letters in its spans times its
    probability against the other languages given the words of these spans."""
    letters = table.letters[words]
    if not letters.sum() or not len(prior):
        return None, 0.0
    held = np.bincount(labels, letters, len(prior))
    best = int(held.argmax())
    evidence = prior + table.scores[words[labels == best]].sum(axis=0, dtype=np.float64)
    sure = 1.0 / np.exp(np.minimum(evidence - evidence[best], 700.0)).sum()
    return best, float(held[best] / letters.sum() * sure)


def label(texts: list[str], table: Table, spans: bool = False, switch: float = SWITCH) -> list[tuple[str, float, list]]:
    """Language, score and spans (first code point, length, language) of each text."""
    model = table.model
    if len(table) > TABLE:
        table.clear()
        table.__init__(model)
    places: list[list] = [[] for _ in texts]
    words = [word_numbers(t, table, p if spans else None) for t, p in zip(texts, places)]
    table.settle()
    if not model.langs:
        return [("und", 0.0, []) for _ in texts]
    labels = viterbi(words, table.scores, model.prior, switch)
    out = []
    for w, y, p in zip(words, labels, places):
        best, score = judge(w, y, table, model.prior)
        cuts = []
        if spans and best is not None:
            borders = [0, *(np.flatnonzero(np.diff(y)) + 1).tolist(), len(y)]
            cuts = [{"start": p[a][0], "length": p[b - 1][1] - p[a][0], "lang": model.langs[y[a]]} for a, b in zip(borders, borders[1:])]
        out.append(("und" if best is None else model.langs[best], score, cuts))
    return out


def identify(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", spans: bool = True, block: int = 1024) -> DataFrame:
    """``key, lang_pred, score`` and, if asked, ``spans``: array of first code point, length and language.

    Null texts, and texts without a letter, are ``und`` with score 0 and without spans; so is every text if nothing was learned.  Texts of any length are labelled
    whole.  Equal texts get equal answers, repeated rows one row each; languages that tie go to the alphabetically first.  A text in a script that
    no learned language uses gets the most frequent language with a low score.  Only key and text are read, so other columns cannot clash; no rows give no rows.
    """
    kind = df.schema[key].dataType.simpleString()
    narrow = df.select(F.col(key).alias("key"), text_of(text).alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the sample it was fitted on
    fields = [("start", pa.int64()), ("length", pa.int64()), ("lang", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(shared.value)
        for batch in pieces_of(batches, block):
            found = label(batch.column(1).to_pylist(), table, spans)
            arrays = [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            if spans:
                arrays.append(pa.array([f[2] for f in found], pa.list_(pa.struct(fields))))
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "lang_pred", "score", "spans"][: len(arrays)])

    schema = f"key {kind}, lang_pred string, score double" + (", spans array<struct<start: long, length: long, lang: string>>" if spans else "")
    return narrow.mapInArrow(run, schema).withColumnRenamed("key", key)
