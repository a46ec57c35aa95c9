"""Sequence packing by minimum bin slack.

1. Texts become ids; a document (its ids and one closing id) is cut into full windows and a
   remainder.  Full windows are sequences of their own.
2. Remainders are dealt at random to shards of a bounded number of rows.  In a shard, the
   longest remaining remainder opens a window and a subset-sum dynamic programme over bitsets
   (bit ``s`` of a Python integer: sum ``s`` can be reached) finds the multiset of remaining
   lengths that leaves the least slack; walking the bitsets back gives the count of each length.
   A multiset is used as often as the counts allow.
3. A few documents, chosen by a hash, keep their ids with them and can be cut anywhere.  They close
   what slack is left, and the last tokens of a shard go to windows whose lengths are powers of two.

Memory is bounded by the rows of a shard; the number of shards follows the number of documents.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from sys import getsizeof

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stokesweave.llm.byte_bpe import CHUNK
from stokesweave.llm.common import pieces_of, text_of
from stokesweave.session import cut_lineage

CACHE_BYTES = 260_000_000  # cached chunks of a worker and their ids, dictionary included; emptied when full
LONG_CHUNK = 256  # characters of a chunk that is too long to be met again


class ChunkEncoder:
    """Ids as the library gives them without special tokens of its own.

    A chunk (white space and the word after it) is encoded once and then looked up.  A text that holds an added
    token of the tokenizer, such as its end mark, is encoded whole, as added tokens are cut out before
    all else and may reach over chunks; with a normalizer every text is.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("" if self.tokenizer.normalizer is not None else "|".join(map(re.escape, added)) or r"(?!)")
        self.known: dict[str, bytes] = {}
        self.held = 0

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if self.held > CACHE_BYTES:
            self.known, self.held = {}, 0
        known, whole = self.known, self.whole.search
        # a whole text is one chunk, under a key that no chunk has
        cut = [[(t,)] if whole(t) else CHUNK.findall(t) for t in texts]
        fresh = list(set().union(*cut).difference(known)) if cut else []
        passing = []
        for chunk, coded in zip(fresh, self.tokenizer.encode_batch([c if isinstance(c, str) else c[0] for c in fresh], add_special_tokens=False)):
            known[chunk] = ids = array("I", coded.ids).tobytes()
            if isinstance(chunk, str) and len(chunk) <= LONG_CHUNK:
                self.held += getsizeof(chunk) + getsizeof(ids) + 100
            else:
                passing.append(chunk)
        get = known.__getitem__
        out = [np.frombuffer(b"".join(map(get, c)), dtype="<u4") for c in cut]
        for chunk in passing:
            del known[chunk]
        return out


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The encoder of this Python worker for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def best_fill(counts: list[int], capacity: int, longest: int) -> tuple[dict[int, int], int]:
    """The multiset of lengths with the largest sum up to ``capacity``.

    ``counts[l]`` pieces of length ``l`` up to ``longest`` are there.  Returns the count of each
    length used, and the sum.  Lengths enter from the longest; once the capacity itself is
    reached no shorter length is looked at.
    """
    full = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    goal = 1 << capacity
    for length in range(min(longest, capacity), 0, -1):
        left, batch = min(counts[length], capacity // length), 1
        while left > 0:  # binary splitting: any count up to counts[length] is a sum of these batches
            take = min(batch, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & full
            left -= take
            batch *= 2
        if reach & goal:
            break
    total = at = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:  # sum only reachable with this batch
            used[length] = used.get(length, 0) + take
            at -= length * take
    return used, total


def pack_lengths(lengths: np.ndarray, window: int, spare: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Pack pieces of fewer than ``window`` tokens: rows ``(piece, start, length, sequence, offset)``.

    ``spare`` marks pieces that may be cut.  Whole pieces are packed first; spare ones then
    close the slack.  Windows that are not full have a power of two as length wherever cutting allows it.
    """
    out: list[tuple[int, int, int, int, int]] = []
    whole: list[deque[int]] = [deque() for _ in range(window + 1)]
    for piece in np.flatnonzero(~spare).tolist():
        whole[lengths[piece]].append(piece)
    counts = [len(w) for w in whole]
    # pieces that may be cut, longest first; [piece, start, tokens left]
    loose = deque([p, 0, int(lengths[p])] for p in sorted(np.flatnonzero(spare).tolist(), key=lambda p: -lengths[p]))
    sequence = 0

    def fill(offset: int, room: int) -> int:
        while room and loose:
            piece, start, left = loose[0]
            take = min(room, left)
            out.append((piece, start, take, sequence, offset))
            offset, room = offset + take, room - take
            if take == left:
                loose.popleft()
            else:
                loose[0] = [piece, start + take, left - take]
        return offset

    longest = window
    while True:
        while longest and not counts[longest]:
            longest -= 1
        if not longest:
            break
        counts[longest] -= 1
        used, total = best_fill(counts, window - longest, longest)
        counts[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        total += longest
        times = min(counts[length] // n for length, n in used.items()) if total == window else 1
        for _ in range(times):
            offset = 0
            for length, n in used.items():
                for _ in range(n):
                    out.append((whole[length].popleft(), 0, length, sequence, offset))
                    offset += length
            if total < window:
                room = sum(left for _, _, left in loose)
                # up to the window if the spare tokens reach, else to the largest power of two they reach
                goals = [window] + [g for g in (1 << b for b in range(window.bit_length() - 1, -1, -1)) if offset <= g < window]
                goal = next((g for g in goals if g - offset <= room), offset)
                fill(offset, goal - offset)
            sequence += 1
        for length, n in used.items():
            counts[length] -= n * times
    while loose:
        left = sum(x[2] for x in loose)
        fill(0, window if left >= window else 1 << (left.bit_length() - 1))
        sequence += 1
    return out


def pack(
    df: DataFrame,
    tokenizer: str,
    window: int = 2048,
    end_id: int = 1,
    key: str = "doc_id",
    text: str = "text",
    shard_rows: int = 20_000,
    spare_share: int = 32,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``window`` tokens.

    Returns ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset``; pieces of a
    document cover its ids and the closing id once, pieces of a sequence lie gapless from 0.
    Null and empty texts are documents of the closing id alone.  Rows with equal keys are
    packed each for itself, and so are rows with a null key.  ``sequence_id`` holds the shard in its high bits.
    """
    kind = df.schema[key].dataType.simpleString()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            rows: dict[str, list] = {n: [] for n in ("key", "uid", "doc_tokens", "full", "rest", "crc", "ids")}
            for k, uid, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), encoder(tokenizer).ids(batch.column(2).to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                at = len(ids) // window * window
                rest = ids[at:].tobytes()
                rows["key"].append(k)
                rows["uid"].append(uid)
                rows["doc_tokens"].append(len(ids))
                rows["full"].append([zlib.crc32(ids[i : i + window].tobytes()) for i in range(0, at, window)])
                rows["rest"].append(len(ids) - at)
                rows["crc"].append(zlib.crc32(rest))
                rows["ids"].append(rest if uid % spare_share == 0 else None)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("key", batch.schema.field(0).type), ("uid", pa.int64()), ("doc_tokens", pa.int64()), ("full", pa.list_(pa.int64())), ("rest", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary())]))

    # the row id mixes a row's place into its hash, so repeated rows spread over shards; it is fixed by the written stage
    uid = F.xxhash64(F.col(key), F.length(text_of(text)), F.monotonically_increasing_id())
    rows = cut_lineage(
        df.select(F.col(key).alias("key"), uid.alias("uid"), text_of(text).alias("text")).mapInArrow(
            coded, f"key {kind}, uid bigint, doc_tokens bigint, full array<bigint>, rest bigint, crc bigint, ids binary"
        )
    )
    shards = max(1, -(-rows.count() // shard_rows))
    full = rows.select("key", "uid", "doc_tokens", F.posexplode("full").alias("n", "crc")).select(
        F.col("key").alias(key),
        (F.col("n") * F.lit(window)).cast("bigint").alias("start"),
        F.lit(window).cast("bigint").alias("length"),
        F.col("crc").alias("ids_crc32"),
        "doc_tokens",
        # negative ids are those of full windows, one for each
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )

    # Arrow throughout: a key column with a null keeps its type
    def packed(shard: pa.Table) -> pa.Table:
        shard = shard.take(pc.sort_indices(shard, [("rest", "descending"), ("uid", "ascending")])).combine_chunks()
        lengths = shard["rest"].to_numpy()
        ids = shard["ids"].to_pylist()
        placed = pack_lengths(lengths, window, np.array([i is not None for i in ids], dtype=bool))
        piece, start, length, sequence, offset = (np.array(c, dtype=np.int64) for c in zip(*placed))
        crc = shard["crc"].to_numpy()[piece]
        for i in np.flatnonzero(length < lengths[piece]).tolist():
            crc[i] = zlib.crc32(ids[piece[i]][4 * start[i] : 4 * (start[i] + length[i])])
        doc_tokens = shard["doc_tokens"].to_numpy()[piece]
        return pa.table(
            {
                key: shard["key"].take(pa.array(piece)),
                "start": doc_tokens - lengths[piece] + start,
                "length": length,
                "ids_crc32": crc,
                "doc_tokens": doc_tokens,
                "sequence_id": (shard["shard"].to_numpy()[piece] << 32) + sequence,
                "offset": offset,
            }
        )

    rest = (
        rows.filter("rest > 0")
        .select("key", "uid", "doc_tokens", "rest", "crc", "ids", F.pmod(F.xxhash64("uid"), F.lit(shards)).alias("shard"))
        .groupBy("shard")
        .applyInArrow(packed, f"`{key}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
    )
    return full.unionByName(rest)
