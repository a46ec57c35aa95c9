"""Byte-level BPE encoding and decoding by a segment tree over byte positions.

Leaf ``i`` of the tree holds the rank of the pair that starts at live byte position
``i`` together with ``i`` itself, so the root is the leftmost pair of the lowest rank.
A merge keeps the left position, removes the right one from the linked list of live
positions and rewrites three leaves: the merged position, its left neighbour and the
removed position.  Each rewrite climbs one path of the tree.

Short pieces of a batch are encoded together, one tree per row of a numpy matrix;
long pieces have a tree of their own.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stokesweave.llm.common import map_texts

#: fixed values: White_Space of Unicode, as the splitting pattern's \s means it
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A run of white space with the run of other characters after it.  No match of the splitting
#: pattern reaches over the start of such a chunk, and the pattern looks ahead no further than its end.
CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
LONGEST_ROW = 64  # bytes of a piece that shares a matrix
CACHE_BYTES = 300_000_000  # cached chunks and pieces of a worker, dictionaries included; emptied when full
LONG_CHUNK = 256  # characters of a chunk or piece that is too long to be met again
NONE = np.int64(2**62)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file: one base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class SegmentTreeBpe:
    """Encoder and decoder for one table of ranks.  ``pattern`` splits text before the merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        # \s is written out: the regex module also counts \x1c-\x1f as white space
        spelled = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"(?!\S)", f"(?![^{WHITE}])").replace(r"\s", f"[{WHITE}]")
        self.pattern = regex.compile(spelled)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        key = np.array(left, dtype=np.int64) << 32 | np.array(right, dtype=np.int64)
        order = np.argsort(key)
        self.pair_key, self.pair_rank = np.append(key[order], NONE), np.append(np.array(merged, dtype=np.int64)[order], -1)
        self.pair = dict(zip(key.tolist(), merged))
        self.pieces: dict[str, list[int]] = {}
        self.chunks: dict[str, tuple[int, str, bytes]] = {}
        self.held = 0  # bytes of both caches

    # -- one long piece ---------------------------------------------------

    def encode_long(self, data: bytes) -> list[int]:
        n = len(data)
        ids = [int(self.byte_id[b]) for b in data]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        size = 1 << max(0, (n - 1).bit_length())
        shift, top = size.bit_length(), int(NONE)
        tree = [top] * (2 * size)
        pair = self.pair

        def leaf(i: int) -> int:
            j = after[i]
            rank = pair.get(ids[i] << 32 | ids[j]) if j < n else None
            return top if rank is None else rank << shift | i

        for i in range(n - 1):
            tree[size + i] = leaf(i)
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i: int, value: int) -> None:
            i += size
            tree[i] = value
            while i > 1:
                i >>= 1
                best = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == best:
                    break
                tree[i] = best

        while tree[1] != top:
            i, rank = tree[1] & ((1 << shift) - 1), tree[1] >> shift
            gone = after[i]
            ids[i], after[i] = rank, after[gone]
            if after[i] < n:
                before[after[i]] = i
            put(gone, top)
            put(i, leaf(i))
            if before[i] >= 0:
                put(before[i], leaf(before[i]))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    # -- many short pieces ------------------------------------------------

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the pair has none."""
        key = left << 32 | right
        at = np.searchsorted(self.pair_key, key)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], -1)

    def encode_rows(self, data: list[bytes]) -> list[list[int]]:
        """All pieces of at most ``LONGEST_ROW`` bytes at once."""
        n, lens = len(data), np.array([len(d) for d in data], dtype=np.int64)
        width = 1 << max(1, (int(lens.max()) - 1).bit_length())
        shift = width.bit_length()
        raw = np.frombuffer(b"".join(d.ljust(width, b"\0") for d in data), dtype=np.uint8).reshape(n, width)
        # one more column stands for the end of the piece
        ids = np.concatenate([self.byte_id[raw], np.full((n, 1), -1, dtype=np.int64)], axis=1)
        place = np.arange(width + 1, dtype=np.int64)
        live = place[None, :] < lens[:, None]
        ids[~live] = -1
        after = np.minimum(place + 1, lens[:, None])
        before = np.tile(place - 1, (n, 1))
        tree = np.full((n, 2 * width), NONE, dtype=np.int64)
        rank = self._rank(ids[:, :width].ravel(), ids[:, 1 : width + 1].ravel()).reshape(n, width)
        ok = (rank >= 0) & live[:, 1:]
        tree[:, width:][ok] = (rank << shift | place[:width])[ok]
        for i in range(width - 1, 0, -1):
            tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])

        def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray | np.int64) -> None:
            node = at + width
            tree[rows, node] = value
            for _ in range(shift - 1):
                node >>= 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        def leaf(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
            rank = self._rank(ids[rows, at], ids[rows, after[rows, at]])
            return np.where(rank >= 0, rank << shift | at, NONE)

        rows = np.flatnonzero(tree[:, 1] != NONE)
        while len(rows):
            root = tree[rows, 1]
            at, rank = root & ((1 << shift) - 1), root >> shift
            gone = after[rows, at]
            ids[rows, at] = rank
            then = after[rows, gone]
            after[rows, at] = then
            before[rows, then] = at
            live[rows, gone] = False
            put(rows, gone, NONE)
            put(rows, at, leaf(rows, at))
            left = before[rows, at]
            has = left >= 0
            put(rows[has], left[has], leaf(rows[has], left[has]))
            rows = rows[tree[rows, 1] != NONE]
        flat = ids[live].tolist()
        ends = np.cumsum(live.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    # -- text -------------------------------------------------------------

    def encode_pieces(self, pieces: Iterable[str]) -> None:
        """Fill the cache of pieces."""
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            data = piece.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                self.pieces[piece] = [rank]
            elif len(data) > LONGEST_ROW:
                self.pieces[piece] = self.encode_long(data)
            else:
                groups.setdefault((len(data) - 1).bit_length(), []).append((piece, data))
        for members in groups.values():
            for at in range(0, len(members), 8192):
                part = members[at : at + 8192]
                for (piece, _), ids in zip(part, self.encode_rows([d for _, d in part])):
                    self.pieces[piece] = ids

    def encode_texts(self, texts: list[str]) -> list[list[tuple[int, str, bytes]]]:
        """For each text its chunks as (number of ids, ids as text, bytes that the ids decode to)."""
        if self.held > CACHE_BYTES:
            self.chunks, self.pieces, self.held = {}, {}, 0
        cut = [CHUNK.findall(t) for t in texts]
        fresh = set().union(*cut).difference(self.chunks) if cut else set()
        split = {c: self.pattern.findall(c) for c in fresh}
        new = {p for ps in split.values() for p in ps}.difference(self.pieces)
        self.encode_pieces(new)
        for chunk, pieces in split.items():
            ids = [i for p in pieces for i in self.pieces[p]]
            self.chunks[chunk] = (len(ids), ",".join(map(str, ids)), self.decode(ids))
        get = self.chunks.__getitem__
        out = [list(map(get, c)) for c in cut]
        # estimates with the objects' own size and a place in the dictionary
        for piece in new:
            if len(piece) > LONG_CHUNK:
                del self.pieces[piece]
            else:
                self.held += 200 + 36 * len(self.pieces[piece]) + 4 * len(piece)
        for chunk in fresh:
            if len(chunk) > LONG_CHUNK:
                del self.chunks[chunk]
            else:
                self.held += 400 + 8 * self.chunks[chunk][0] + 5 * len(chunk)
        return out

    def encode(self, text: str) -> list[int]:
        ids = ",".join(c[1] for c in self.encode_texts([text])[0])
        return [int(i) for i in ids.split(",")] if ids else []

    def decode(self, ids: Iterable[int]) -> bytes:
        token = self.token
        return b"".join([token[i] for i in ids])


_ENCODERS: dict[tuple[str, str], SegmentTreeBpe] = {}


def encoder(path: str, pattern: str) -> SegmentTreeBpe:
    """The encoder of this Python worker for a rank file."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = SegmentTreeBpe(read_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of every text: ``key``, ``ids`` array<int>.  Null and empty texts have no ids.

    Rows stay rows: ties and repeated rows are encoded each for itself.
    """

    def run(keys: list, texts: list[str]) -> dict[str, list]:
        ids = [",".join(c[1] for c in cs) for cs in encoder(path, pattern).encode_texts(texts)]
        return {key: keys, "ids": [[int(i) for i in x.split(",")] if x else [] for x in ids]}

    return map_texts(df, run, f"`{key}` {df.schema[key].dataType.simpleString()}, ids array<int>", key, text)


def decode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Bytes of every id list: ``key``, ``data`` binary; a null list decodes to no bytes."""
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, data binary"

    def run(batches):
        for batch in batches:
            enc = encoder(path, pattern)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([enc.decode(x or []) for x in batch.column(1).to_pylist()], pa.binary())], [key, "data"])

    return df.select(key, ids).mapInArrow(run, schema)


def encode_digest(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256``: digests of the ids and of what they decode to.

    Every row of the input gives one row.  Null texts count as empty; an empty text
    has no ids and the digests of nothing.
    """

    def run(keys: list, texts: list[str]) -> dict[str, list]:
        coded = encoder(path, pattern).encode_texts(texts)
        return {
            key: keys,
            "n_tokens": [sum([c[0] for c in cs]) for cs in coded],
            "ids_sha256": [hashlib.sha256(",".join([c[1] for c in cs]).encode()).hexdigest() for cs in coded],
            "decoded_sha256": [hashlib.sha256(b"".join([c[2] for c in cs])).hexdigest() for cs in coded],
        }

    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_texts(df, run, schema, key, text)
