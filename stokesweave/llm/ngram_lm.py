"""Stupid-backoff scores of documents under the corpus's own n-gram counts.

The count of an n-gram is a fact about the whole corpus, and documents hold about as many distinct n-grams
as words.  So counts travel, and n-grams once:

1. Documents are dealt to batches of a bounded number of characters, one shuffle.  A batch explodes its
   documents into n-grams (64-bit keys) and sends its distinct ones with their counts, sorted, in one block to each
   hash partition of the count table.
2. A partition of the count table adds up the blocks of all batches and answers each block with the
   corpus counts of its n-grams, in the block's order, so keys need not go back.
3. A batch joins the answers to its exploded n-grams and sums the scores per document.

A partition of the table and a batch hold a bounded number of n-grams; their numbers follow the corpus.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stokesweave.llm.common import text_of

MULTIPLY = np.uint64(0x9E3779B97F4A7C15)  # an odd constant, the golden ratio in 64 bits


def word_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all words of the texts in order, and where each text ends.  Words are runs without ASCII white space, A-Z lower-cased."""
    words, ends = [], []
    for t in texts:
        words += t.encode().lower().split()
        ends.append(len(words))
    known = {w: xxhash.xxh64_intdigest(w) for w in dict.fromkeys(words)}
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)), np.array(ends, dtype=np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MULTIPLY
    return x ^ (x >> np.uint64(29))


def gram_keys(words: np.ndarray, ends: np.ndarray, order: int) -> list[np.ndarray]:
    """For each n up to ``order`` the keys of the n-grams that end at each word, 0 where a text has no such n-gram yet."""
    starts = np.concatenate([[0], ends[:-1]])
    place = np.arange(len(words)) - np.repeat(starts, ends - starts)
    out = [mixed(words) | np.uint64(1)]
    for n in range(2, order + 1):
        keys = np.zeros(len(words), dtype=np.uint64)
        keys[1:] = mixed(out[-1][:-1] * np.uint64(2 * n + 1) + words[1:] * MULTIPLY) | np.uint64(1)
        keys[place < n - 1] = 0
        out.append(keys)
    return out


def table_part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Hash partition of sorted keys, by their upper bits, so a partition is a run of them."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as a byte string of less than 8 bytes each: the steps between them by byte places, the upper ones compressed."""
    if not len(keys):
        return b""
    steps = np.diff(keys)
    places = np.ascontiguousarray(steps.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    low, high = places[:4].tobytes(), zlib.compress(places[4:].tobytes(), 1)
    return len(keys).to_bytes(8, "little") + int(keys[0]).to_bytes(8, "little") + low + high


def unpack_keys(packed: bytes) -> np.ndarray:
    """The keys that ``pack_keys`` packed."""
    if not packed:
        return np.zeros(0, dtype="<u8")
    n, first = (int.from_bytes(packed[a : a + 8], "little") for a in (0, 8))
    low = packed[16 : 16 + 4 * (n - 1)]
    places = np.frombuffer(low + zlib.decompress(packed[16 + len(low) :]), dtype=np.uint8).reshape(8, n - 1)
    steps = np.ascontiguousarray(places.T).view("<u8").ravel()
    return np.concatenate([np.array([first], dtype="<u8"), steps]).cumsum(dtype=np.uint64)


def distinct_grams(texts: list[str], order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Keys by order and text ends; sorted distinct keys and their counts."""
    words, ends = word_keys(texts)
    grams = gram_keys(words, ends, order)
    keys, counts = np.unique(np.concatenate([g[g > 0] for g in grams]), return_counts=True)
    return grams, ends, keys, counts


def backoff(grams: list[np.ndarray], keys: np.ndarray, totals: np.ndarray, n_words: int, least: int, alpha: float) -> np.ndarray:
    """Log score of each word: relative frequency of the longest n-gram that counts ``least`` or more, times alpha for each step down."""

    def count(g: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(g))
        at = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
        return np.where(keys[at] == g, totals[at], 0).astype(np.float64)

    tables = [count(g) for g in grams]
    score = np.log(tables[0] / max(n_words, 1)) if len(tables[0]) else np.zeros(0)
    for n in range(1, len(grams)):
        context = np.concatenate([[1.0], tables[n - 1][:-1]]) if len(score) else score
        has = grams[n] > 0
        used = has & (tables[n] >= least)
        lower = score + np.where(has, np.log(alpha), 0.0)
        score = np.where(used, np.log(np.maximum(tables[n], 1) / np.maximum(context, 1)), lower)
    return score


def score(
    df: DataFrame,
    order: int = 2,
    least: int = 2,
    alpha: float = 0.4,
    batch_chars: int = 8_000_000,
    table_rows: int = 2_000_000,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key, n_words, log_score, mean_log_score``: summed and mean log score of a document's words.

    A word's n-gram of ``order`` words counts if the corpus has it ``least`` times; otherwise the next shorter
    one is used with factor ``alpha``; single words always count.  The first words of a text have shorter
    n-grams and no factor for it.  Null and empty texts have no words, score 0 and a null mean.
    Repeated rows count, and are scored, each for itself.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    base = df.select(F.col(key).alias("key"), text_of(text).alias("text"))
    chars = base.agg(F.sum(F.length("text"))).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    batches = max(tasks, -(-chars // batch_chars))
    parts = max(tasks, -(-chars // (4 * table_rows)))
    docs = base.withColumn("batch", F.pmod(F.xxhash64("key", "text"), F.lit(batches)))

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        _, _, keys, counts = distinct_grams(pdf["text"].tolist(), order)
        part = table_part(keys, parts)
        cuts = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
        held = np.flatnonzero(np.diff(cuts))
        return pd.DataFrame(
            {
                "part": held,
                "batch": pdf["batch"].iloc[0],
                "keys": [pack_keys(keys[cuts[p] : cuts[p + 1]]) for p in held],
                "counts": [zlib.compress(counts[cuts[p] : cuts[p + 1]].astype("<u4").tobytes(), 1) for p in held],
            }
        )

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_keys(k) for k in pdf["keys"]]
        counts = np.concatenate([np.frombuffer(zlib.decompress(c), dtype="<u4") for c in pdf["counts"]])
        every, where = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(where, counts, len(every)).astype("<u8")[where]
        ends = np.cumsum([len(k) for k in keys])
        return pd.DataFrame({"batch": pdf["batch"], "part": pdf["part"], "totals": [zlib.compress(totals[a:b].tobytes(), 1) for a, b in zip([0, *ends[:-1]], ends)]})

    def sum_up(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        grams, ends, keys, _ = distinct_grams(pdf["text"].tolist(), order)
        answers = answers.sort_values("part")
        totals = np.concatenate([np.frombuffer(zlib.decompress(t), dtype="<u8") for t in answers["totals"]] or [np.zeros(0, dtype="<u8")])
        by_word = backoff(grams, keys, totals, n_words, least, alpha)
        starts = np.concatenate([[0], ends[:-1]])
        size = ends - starts
        sums = np.array([by_word[a:b].sum() for a, b in zip(starts, ends)])
        return pd.DataFrame({key: pdf["key"].to_numpy(), "n_words": size, "log_score": sums, "mean_log_score": pd.Series(sums).div(pd.Series(size).where(size > 0)).astype("Float64")})

    words = docs.select(F.size(F.filter(F.split("text", "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")).alias("n"))
    n_words = words.agg(F.sum("n")).first()[0] or 0
    blocks = docs.groupBy("batch").applyInPandas(send, "part bigint, batch bigint, keys binary, counts binary")
    answers = blocks.groupBy("part").applyInPandas(add_up, "batch bigint, part bigint, totals binary")
    return (
        docs.groupBy("batch")
        .cogroup(answers.groupBy("batch"))
        .applyInPandas(sum_up, f"`{key}` {kind}, n_words bigint, log_score double, mean_log_score double")
    )


def oracle(alpha: float = 0.4, least: int = 2) -> str:
    """DuckDB SQL of the ``op10`` query: two words, rounded as there."""
    return f"""
WITH parts AS (
  SELECT doc_id, list_filter(string_split_regex(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS ws
  FROM documents
),
words AS (SELECT doc_id, i, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS u FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM parts)),
one AS (SELECT w, COUNT(*) AS n FROM words GROUP BY w),
two AS (SELECT u, w, COUNT(*) AS n FROM words WHERE u IS NOT NULL GROUP BY u, w HAVING COUNT(*) >= {least}),
total AS (SELECT COUNT(*) AS n FROM words),
scored AS (
  SELECT t.doc_id, CASE WHEN two.n IS NOT NULL THEN LN(two.n / CAST(c.n AS DOUBLE))
    ELSE LN(one.n / CAST(total.n AS DOUBLE)) + CASE WHEN t.u IS NULL THEN 0 ELSE LN({alpha}) END END AS s
  FROM words t JOIN one ON one.w = t.w LEFT JOIN one c ON c.w = t.u LEFT JOIN two ON two.u = t.u AND two.w = t.w CROSS JOIN total
)
SELECT p.doc_id, CAST(len(p.ws) AS BIGINT) AS n_words, ROUND(COALESCE(s.s, 0), 4) + CAST(0 AS DOUBLE) AS log_score
FROM parts p LEFT JOIN (SELECT doc_id, SUM(s) AS s FROM scored GROUP BY doc_id) s ON s.doc_id = p.doc_id
"""
