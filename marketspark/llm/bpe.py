"""Byte-level BPE by segment trees over byte positions.

A match of the splitting pattern is cut into bytes. A segment tree over their positions keeps in every node the leftmost
position with the least pair rank below it, as ``rank * width + position``; the root is the next merge. A merge joins two
live neighbours and changes three leaves at most, each with one walk to the root, so a match of n bytes takes O(n log n).
Matches of up to 32 bytes are merged many at a time, one tree per row of an array, which is 8, 16 or 32 wide; longer ones one by one, of any length.
A match that is itself in the vocabulary is its token, as the tiktoken library has it.

Texts are cut at single spaces first: a space between two characters that are no white space always opens a new match, so
each such piece is encoded by itself, once in a group of texts, and remembered in a bounded per-worker store if the group has
it twice. Where white space stands together the pattern is run over the joined pieces. Neither changes a result.

Defined cases: a null text is an empty one, and has no tokens. Very long matches are handled whole. Rows are
independent, so ties, repeated rows and clashing columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.llm.common import ship

_NONE = 1 << 60
_PIECES = 60_000  # a generation of what a worker remembers
_CHARS = 3_000_000  # texts are encoded together up to so many characters, or one by one if longer


def load_ranks(lines: list[bytes]) -> dict[bytes, int]:
    """Ranks from the lines of a rank file: base64 of the bytes, then the rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one match: least rank first, leftmost among equals."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    width = 1 << (n - 1).bit_length()
    get = ranks.get
    tree = [_NONE] * (2 * width)
    for i in range(n - 1):
        rank = get(piece[i:i + 2])
        if rank is not None:
            tree[width + i] = rank * width + i
    for node in range(width - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b
    end = list(range(1, n + 1))  # of the live token that starts at i
    before = list(range(-1, n - 1))  # start of the live token to the left

    def put(at: int, value: int) -> None:
        node = width + at
        if tree[node] == value:
            return
        tree[node] = value
        while node > 1:
            other = tree[node ^ 1]
            node >>= 1
            least = value if value < other else other
            if tree[node] == least:
                break
            tree[node] = value = least

    def rank_at(at: int) -> int:
        """Of the pair whose left token starts at ``at``."""
        middle = end[at]
        rank = get(piece[at:end[middle]]) if middle < n else None
        return _NONE if rank is None else rank * width + at

    while tree[1] != _NONE:
        at = tree[1] % width
        gone = end[at]
        end[at] = end[gone]
        put(gone, _NONE)
        if end[at] < n:
            before[end[at]] = at
        put(at, rank_at(at))
        if before[at] >= 0:
            put(before[at], rank_at(before[at]))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at:end[at]]])
        at = end[at]
    return ids


class Forest:
    """Merges many short matches at once; row i of every array belongs to match i."""

    WIDTHS = 8, 16, 32  # of trees, for matches of up to so many bytes
    ROWS = 4096  # merged together

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self._base = max(ranks.values()) + 1
        pairs = {
            ranks[token[:k]] * self._base + ranks[token[k:]]: rank
            for token, rank in ranks.items() for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks
        }
        self._keys = np.array(sorted(pairs), dtype=np.int64)
        self._ranks = np.array([pairs[k] for k in self._keys.tolist()], dtype=np.int64)
        self._of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)

    def _leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
        key = left * self._base + right
        found = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[found] == key, self._ranks[found] * width + at, _NONE)

    def _put(self, tree: np.ndarray, rows: np.ndarray, at: np.ndarray, value: np.ndarray | int) -> None:
        node = at + tree.shape[1] // 2
        tree[rows, node] = value
        while node[0] > 1:  # all leaves are equally deep
            node >>= 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def merge(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Token ids of each piece, of 1 to 32 bytes."""
        out: list[tuple[int, ...]] = [()] * len(pieces)
        length = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        least = 0
        for width in self.WIDTHS:
            some = np.flatnonzero((length > least) & (length <= width)).tolist()
            least = width
            for k in range(0, len(some), self.ROWS):
                part = some[k:k + self.ROWS]
                for i, ids in zip(part, self._merge([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _merge(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        many = len(pieces)
        length = np.array([len(p) for p in pieces], dtype=np.int64)
        filled = np.arange(width) < length[:, None]
        token = np.full((many, width), -1, dtype=np.int64)
        token[filled] = self._of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        tree = np.full((many, 2 * width), _NONE, dtype=np.int64)
        row, at = np.nonzero(filled[:, 1:])
        tree[row, width + at] = self._leaf(token[row, at], token[row, at + 1], at, width)
        for node in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        end = np.tile(np.arange(1, width + 1), (many, 1))
        before = np.tile(np.arange(-1, width - 1), (many, 1))
        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            root = tree[rows, 1]
            at = root % width
            gone = end[rows, at]
            after = end[rows, gone]
            token[rows, at] = root // width  # the rank of a pair is the id of the joined token
            token[rows, gone] = -1
            end[rows, at] = after
            self._put(tree, rows, gone, _NONE)
            more = after < length[rows]
            some, here, there = rows[more], at[more], after[more]
            before[some, there] = here
            value = np.full(len(rows), _NONE, dtype=np.int64)
            value[more] = self._leaf(token[some, here], token[some, there], here, width)
            self._put(tree, rows, at, value)
            left = before[rows, at]
            more = left >= 0
            some, here, there = rows[more], left[more], at[more]
            if len(some):
                self._put(tree, some, here, self._leaf(token[some, here], token[some, there], here, width))
            rows = rows[tree[rows, 1] != _NONE]
        live = token >= 0
        ids, ends = token[live].tolist(), np.cumsum(live.sum(1)).tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


Ids = tuple[int, ...]
Entry = tuple[Ids, str, bytes]  # ids, the same as decimal text, and the bytes they decode to


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a rank: {missing}")
        self.ranks = ranks
        self._bytes_of = {i: b for b, i in ranks.items()}
        ids = range(max(self._bytes_of) + 1)
        self._raw = pa.array(map(self._bytes_of.get, ids), pa.binary())
        self._decimal = pa.array(map(str, ids), pa.string())
        self._find = regex.compile(pattern).findall
        self._forest = Forest(ranks)
        # Two generations of pieces: what is met again moves to the younger one, and the older one is forgotten when that is full.
        self._pieces: dict[str, Ids | None] = {}
        self._old_pieces = self._pieces

    def _learned(self, matches: set[str]) -> dict[str, Ids]:
        """Ids of each match."""
        get, out, short = self.ranks.get, {}, []
        for match in matches:
            raw = match.encode()
            rank = get(raw)
            if rank is not None:
                out[match] = (rank,)
            elif len(raw) > Forest.WIDTHS[-1]:
                out[match] = tuple(merge(raw, self.ranks))
            else:
                short.append((match, raw))
        if len(short) < 50:  # an array for few rows does not pay
            out.update((match, tuple(merge(raw, self.ranks))) for match, raw in short)
            return out
        out.update(zip((m for m, _ in short), self._forest.merge([r for _, r in short]), strict=True))
        return out

    def _whole(self, text: str) -> Ids:
        matches = self._find(text)
        learned = self._learned(set(matches))
        return tuple(chain.from_iterable(map(learned.__getitem__, matches)))

    def _split(self, piece: str) -> list[str] | None:
        """Matches of a space and the piece; None if the piece is empty or white space stands at one of its ends."""
        if piece.isascii() and piece.isalpha():
            return [" " + piece]
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return None
        if piece[-1] in ".,":
            word = piece[:-1]
            if word.isascii() and word.isalpha():
                return [" " + word, piece[-1]]
        return self._find(" " + piece)

    def _units(self, pieces: list[str], often: list[bool], opening: list[str]) -> tuple[list[Ids | None], list[Ids]]:
        """Ids of the pieces with a space before each, None where a piece has no ids of its own, and of the texts' openings.

        Only pieces met ``often`` are remembered: most others are never met again, and would fill the store.
        """
        if len(self._pieces) > _PIECES:
            self._old_pieces, self._pieces = self._pieces, {}
        known, old = self._pieces, self._old_pieces
        unseen = [p for p in pieces if p not in known]
        known.update((p, old[p]) for p in unseen if p in old)
        split = {p: self._split(p) for p in unseen if p not in old}
        first = [self._find(text) for text in opening]
        learned = self._learned(set(chain(chain.from_iterable(first), chain.from_iterable(m for m in split.values() if m))))
        get = learned.__getitem__
        fresh = {
            p: None if m is None else get(m[0]) if len(m) == 1 else tuple(chain.from_iterable(map(get, m))) for p, m in split.items()}
        found = [fresh[p] if p in fresh else known[p] for p in pieces]
        known.update((p, fresh[p]) for p, many in zip(pieces, often, strict=True) if many and p in fresh)
        return found, [tuple(chain.from_iterable(map(get, m))) for m in first]

    def _joined(self, pieces: list[str], found: list[Ids | None]) -> Ids:
        """Ids of a text from its pieces, the first one aside, where some have none of their own."""
        # A cut before a piece is sound if both sides of the space are: the piece, and the end of the one before.
        out, start = [], 0
        sound = [bool(pieces[0]) and not pieces[0][-1].isspace(), *(f is not None for f in found)]
        for k in range(1, len(pieces) + 1):
            if k == len(pieces) or sound[k] and sound[k - 1]:
                alone = start and k - start == 1 and sound[start]
                out.append(found[start - 1] if alone else self._whole(" " * (start > 0) + " ".join(pieces[start:k])))
                start = k
        return tuple(chain.from_iterable(out))

    def encoded(self, texts: list[str]) -> pa.ListArray:
        """The ids of each text. Every distinct piece of the texts is looked at once."""
        cut = pc.split_pattern(pa.array(texts, pa.string()), " ")
        stops = cut.offsets.to_numpy()[1:].astype(np.int64)
        first = np.append(0, stops[:-1])
        flat = cut.flatten()
        distinct = flat.dictionary_encode()
        pieces, code = distinct.dictionary.to_pylist(), distinct.indices.to_numpy().astype(np.int64)
        opening = [pieces[c] for c in code[first]]
        met = np.bincount(code, minlength=len(pieces))
        found, units = self._units(pieces, (met > 1).tolist(), opening)
        none = len(found) + len(units)  # a unit without ids
        unsound = np.array([f is None for f in found], dtype=bool)[code]
        unsound[first] = [not text or text[-1].isspace() for text in opening]
        for k in np.flatnonzero(np.add.reduceat(unsound, first, dtype=np.int64)).tolist():
            own = code[first[k]:stops[k]]
            units[k] = self._joined([pieces[c] for c in own], [found[c] for c in own[1:]])
            own[1:] = none
        code[first] = len(found) + np.arange(len(texts))
        found = [f or () for f in found] + units + [()]
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ids = pa.array(np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(size.sum())))
        ends = np.append(0, np.cumsum(size[code])[stops - 1])
        listed = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), ids)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), listed.take(pa.array(code)).flatten())

    def encode(self, text: str) -> list[int]:
        return self.encoded([text])[0].as_py()

    def decode(self, ids: tuple[int, ...] | list[int]) -> bytes:
        return b"".join(map(self._bytes_of.__getitem__, ids))

    def _spelled(self, ids: pa.ListArray, words: pa.Array, between: str | bytes) -> pa.Array:
        spelled = pa.ListArray.from_arrays(ids.offsets, words.take(ids.values))
        return pc.binary_join(spelled, pa.scalar(between, words.type))

    def decoded(self, ids: pa.ListArray) -> pa.BinaryArray:
        """The bytes that each list of ids stands for."""
        return self._spelled(ids, self._raw, b"")

    def decimal(self, ids: pa.ListArray) -> pa.StringArray:
        """Each list of ids as decimal numbers with a space between."""
        return self._spelled(ids, self._decimal, " ")

    def batched(self, texts: Iterable[str | None]) -> Iterator[list[Entry]]:
        """For each text the entries that make it up: one, the whole text."""
        for _, group in _groups(texts):
            ids = self.encoded(group)
            for own, decimal, raw in zip(ids, self.decimal(ids), self.decoded(ids), strict=True):
                yield [(tuple(own.as_py()), decimal.as_py(), raw.as_py())]


def _groups(texts: Iterable[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Texts, nulls as empty ones, in groups of a bounded size, each with the place of its first."""
    start, group, size = 0, [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= _CHARS:
            yield start, group
            start, group, size = start + len(group), [], 0
    if group:
        yield start, group


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    with open(path, "rb") as file:
        return Codec(load_ranks(file.readlines()), pattern)


def _tokens(path: str, pattern: str, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The vocabulary file is part of an installed package, so every worker has it.
        own = codec(path, pattern)
        for batch in batches:
            for start, texts in _groups(text.as_py() for text in batch["text"]):  # a bounded number of ids leaves at a time
                ids = own.encoded(texts)
                if not own.decoded(ids).equals(pa.array(texts, pa.string()).cast(pa.binary())):
                    raise ValueError("a text does not survive encoding and decoding")
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in kept), ids.value_lengths().cast(pa.int64()), ids], [*kept, "n_tokens", "ids"])
    return run


def _sha256(values: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(value.as_buffer()).hexdigest() for value in values], pa.string())


def _digests(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for start, texts in _groups(text.as_py() for text in batch["text"]):
                ids = own.encoded(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(start, len(texts)), ids.value_lengths().cast(pa.int64()),
                     _sha256(own.decimal(ids)), _sha256(own.decoded(ids))],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def tokenize(docs: DataFrame, path: str, pattern: str, *columns: str) -> DataFrame:
    """``columns`` of ``docs``, n_tokens and ids, the token ids of each row's whole text; each list of ids is decoded and compared."""
    ship(docs.sparkSession)
    kept = [c for c in columns if c not in ("n_tokens", "ids")]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.select(*dict.fromkeys([*kept, "text"])).mapInArrow(_tokens(path, pattern, kept), schema)


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, and decoded_sha256 of the bytes that the ids decode to."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _digests(path, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
