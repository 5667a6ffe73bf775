"""Byte-level BPE in length-bucketed numpy matrices.

A text is cut by the vocabulary's pattern. Each different piece is encoded
once per worker and kept in a bounded cache. Pieces that the cache lacks are
put in matrices of rows of similar length, one token id per byte, padded with
-1. In each round every row merges its leftmost pair of minimum rank, and the
row is compacted; rows without a mergeable pair leave. Ranks of pairs come from
an open-addressing hash table over (left id, right id).

A piece of more than ``LONG`` bytes would take as many rounds as it has bytes,
so it is merged in a linked list with a heap, which gives the same ids.

Everything is map-only: texts are not shuffled, and a task holds the matrices
of one slice of rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalbook.llm._shared import row_slices

LONG = 512
CACHE_PIECES = 500_000
MATRIX_BYTES = 1 << 22
GROUP_CHARS = 2_000_000
#: Latin letters without the signs among them, and ASCII white space.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
SPACES = "\t\n\x0b\x0c\r "
NONE = np.int32(2**31 - 1)


def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Token bytes -> rank, from ``base64 rank`` lines."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


def _splitter(pattern: str) -> Callable[[str], list[str]]:
    """Cuts a text into the pattern's matches.

    The standard library's engine is twice as fast, but knows no \\p classes.
    A pattern with no classes but \\p{L} and \\p{N} is also compiled for texts
    of ASCII and Latin letters, in which these classes are plain ranges.
    """
    full = regex.compile(pattern).findall
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{SPACES}{LETTERS}0-9]").replace(r"\p{L}", f"[{LETTERS}]").replace(r"\p{N}", "[0-9]").replace(r"\s", f"[{SPACES}]").replace(r"\S", f"[^{SPACES}]")
    if "\\p" in plain:
        return full
    simple, other = re.compile(plain).findall, re.compile(f"[^\x21-\x7e{SPACES}{LETTERS}]").search
    return lambda text: full(text) if other(text) else simple(text)


class PairTable:
    """(left id, right id) -> id of the joined bytes, for every pair that joins to a token."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int32)
        key, value = np.array(keys, dtype=np.int64), np.array(values, dtype=np.int32)
        slot = self._slot(key)
        self.probes = 0
        while len(key):
            self.probes += 1
            free = self.keys[slot] == -1
            _, firsts = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            firsts = firsts[free[firsts]]
            self.keys[slot[firsts]], self.values[slot[firsts]] = key[firsts], value[firsts]
            rest = np.ones(len(key), dtype=bool)
            rest[firsts] = False
            key, value, slot = key[rest], value[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it joins to no token; -1 pads."""
        shape = left.shape
        key = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        out = np.full(len(key), NONE, dtype=np.int32)
        todo = np.flatnonzero((left >= 0).ravel() & (right >= 0).ravel())
        slot = self._slot(key[todo])
        for _ in range(self.probes):
            if not len(todo):
                break
            held = self.keys[slot]
            hit = held == key[todo]
            out[todo[hit]] = self.values[slot[hit]]
            go = ~hit & (held != -1)
            todo, slot = todo[go], (slot[go] + 1) & ((1 << self.bits) - 1)
        return out.reshape(shape)


class ByteBPE:
    """Encoder and decoder for one rank table and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.token_ids = ranks
        self.pieces = _splitter(pattern)
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        count = 1 + max(ranks.values())
        tokens = [b""] * count
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.token_sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.cache: dict[str, bytes] = {}

    def merge_rows(self, rows: list[bytes]) -> Iterator[tuple[int, bytes]]:
        """(place, ids as little-endian 32-bit bytes) of each piece of one bucket."""
        width = max(map(len, rows))
        raw = np.frombuffer(b"".join(row.ljust(width, b"\0") for row in rows), dtype=np.uint8).reshape(len(rows), width)
        lengths = np.array([len(row) for row in rows])
        ids = np.where(np.arange(width) < lengths[:, None], self.byte_ids[raw], np.int32(-1)).T.copy()  # a column for each piece
        alive = np.arange(len(rows))
        pair = self.pairs.ranks(ids[:-1], ids[1:])
        while len(alive):
            width = len(ids)
            if width > 1:
                least = pair.min(axis=0)
                done = least == NONE
            else:
                done = np.ones(len(alive), dtype=bool)
            if done.any():
                ended = ids[:, done].T
                lasting = (ended >= 0).sum(axis=1) * 4
                blob, stride = ended.astype("<u4").tobytes(), 4 * width
                for k, (place, size) in enumerate(zip(alive[done].tolist(), lasting.tolist(), strict=True)):
                    yield place, blob[k * stride : k * stride + size]
                if done.all():
                    return
                go = ~done
                alive, ids, pair, least = alive[go], ids[:, go], pair[:, go], least[go]
            at = (pair == least).argmax(axis=0)  # the leftmost of the least
            every = np.arange(len(alive))
            ids[at, every] = least  # a rank is the id of the joined token
            row = np.arange(width - 1)[:, None]
            ids = np.where(row > at, ids[1:], ids[:-1])  # what stands right of the merged pair moves up
            if width > 2:
                pair = np.where(row[:-1] >= at, pair[1:], pair[:-1])
                before, after = np.flatnonzero(at > 0), np.flatnonzero(at < width - 2)
                pair[at[before] - 1, before] = self.pairs.ranks(ids[at[before] - 1, before], ids[at[before], before])
                pair[at[after], after] = self.pairs.ranks(ids[at[after], after], ids[at[after] + 1, after])
            else:
                pair = pair[:0]

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same ids for a long piece: least rank first, leftmost among equals."""
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]
        n = len(ids)
        first = self.pairs.ranks(ids[:-1], ids[1:])
        heap = [(int(first[k]), int(k)) for k in np.flatnonzero(first != NONE)]
        heapq.heapify(heap)
        token: list[bytes | None] = [bytes([b]) for b in piece]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        get = self.token_ids.get

        def offer(left: int) -> None:
            right = after[left]
            if right < n and (rank := get(token[left] + token[right])) is not None:
                heapq.heappush(heap, (rank, left))

        while heap:
            rank, left = heapq.heappop(heap)
            if token[left] is None or after[left] >= n or get(token[left] + token[after[left]]) != rank:
                continue
            right = after[left]
            token[left] += token[right]
            token[right] = None
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return np.array([get(t) for t in token if t is not None], dtype=np.int32)

    def _encode_new(self, pieces: list[str]) -> None:
        """Put the ids of pieces into the cache, as little-endian 32-bit bytes."""
        cache, buckets = self.cache, defaultdict(list)
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            whole = self.token_ids.get(raw)
            if whole is not None:
                cache[piece] = whole.to_bytes(4, "little")
            elif len(raw) > LONG:
                cache[piece] = self.merge_long(raw).astype("<u4").tobytes()
            else:
                buckets[len(raw) if len(raw) < 16 else 16 << ((len(raw) - 1) // 16).bit_length()].append((piece, raw))
        for width, bucket in buckets.items():
            step = max(1, MATRIX_BYTES // (width * 16))
            for start in range(0, len(bucket), step):
                part = bucket[start : start + step]
                for place, ids in self.merge_rows([raw for _, raw in part]):
                    cache[part[place][0]] = ids

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [self.pieces(text) for text in texts]
        new = set().union(*split).difference(self.cache)
        if len(self.cache) + len(new) > CACHE_PIECES:
            self.cache.clear()
            new = set().union(*split)
        self._encode_new(list(new))
        get = self.cache.__getitem__
        return [b"".join(map(get, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        """The bytes of a text's ids. An id beyond the vocabulary is an error."""
        places = np.frombuffer(ids, dtype="<u4")
        sizes = self.token_sizes[places]
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        from_start = np.repeat(self.token_starts[places] - ends + sizes, sizes)
        return self.token_bytes[from_start + np.arange(ends[-1])].tobytes()


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """Neighbouring texts of about GROUP_CHARS code points together; one text at least."""
    group, chars = [], 0
    for text in texts:
        group.append(text)
        chars += len(text)
        if chars >= GROUP_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


_loaded: dict[tuple[int, str], ByteBPE] = {}


def _worker_bpe(key: tuple[int, str], shared: object) -> ByteBPE:
    """One encoder per worker process, as its tables take a second to build."""
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ByteBPE(shared.value, key[1])
    return _loaded[key]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, ids_column: bool = False) -> DataFrame:
    """Token counts, digests and (if asked for) ids for each row of ``docs``.

    docs: doc_id, text; more columns are ignored. Null texts count as empty
    and have no ids. Result: doc_id, n_tokens, ids_sha256 (of the ids as
    little-endian 32-bit integers), decoded_sha256 (of the bytes that decoding
    these ids gives) and, with ``ids_column``, ids array<int>. The rank table
    is broadcast; its size is that of the vocabulary, whatever the corpus.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    digest = hashlib.sha256(b"".join(t + r.to_bytes(4, "little") for t, r in sorted(ranks.items()))).digest()
    key = (int.from_bytes(digest[:8], "little"), pattern)
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids_column

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _worker_bpe(key, shared)
        for part in row_slices(batches, 1024):
            encoded: list[bytes] = []
            for group in _groups([t or "" for t in part.column(1).to_pylist()]):
                encoded += bpe.encode_texts(group)
            columns = [
                part.column(0),
                pa.array([len(e) // 4 for e in encoded], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in encoded], pa.string()),
                pa.array([hashlib.sha256(bpe.decode(e)).hexdigest() for e in encoded], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids_column:
                ids = np.frombuffer(b"".join(encoded), dtype="<i4")
                ends = np.cumsum([0, *(len(e) // 4 for e in encoded)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)
