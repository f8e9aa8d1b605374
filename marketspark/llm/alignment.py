"""Tokens of two tokenizers over the same bytes, cut into groups where tokens of both end, and how often ids overlap.

Divide and conquer: an interval of one tokenizer's tokens looks, from its middle outwards, for an end that bisection finds among the other's
ends too; the interval is cut there and both parts go on; an interval without such an end is a leaf, a group. The intervals of all texts
of a chunk are worked level by level in arrays.

Where both tokenizers treat the words on either side of a single blank alone (this is read from their files), a worker encodes a word once and
remembers its ids; else texts are encoded whole.

Where groups are known, links follow: between two neighbouring ends of either tokenizer lies exactly one pair of overlapping tokens.

Pairs are counted over the corpus without moving links. A task gathers about ``block_bytes`` of text into a block, numbers the block's distinct pairs by
frequency and keeps each text's links as sorted, coded numbers. Each block sends its distinct pairs with their sums; Spark adds them up, finds the highest count of each id of B (one row per
id, so bounded by that vocabulary), and hands every block the counts of its own pairs, from which the texts' sums follow.

Defined cases: null and empty texts, and those whose tokens do not spell the blank and the text (B rewrites some characters), have no tokens: zeros and an empty
digest. A null doc_id is kept. Repeated rows count each. Strings of special tokens are ordinary text. A very long text is encoded whole, as its tokens demand, and is a chunk and, beyond
the size of a block, a block of its own. Ties for an id's highest count all are best. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import keep, ship

CHUNK_BYTES = 1 << 20
WORDS = 300_000  # remembered at most, before a chunk
LOOSE = -1
ROW_WORDS = 500  # new words encoded in one row
BLOCK_BYTES = 8 << 20
ROWS = 100_000  # rows of an emitted batch
_SHIFT = 16  # ids of B are below 2 ** 16


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself where it is printable, else the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def cuttable(path_a: str, model_b: bytes, pieces_b: list[str]) -> bool:
    """Whether both tokenizers treat what stands on either side of a single blank alone.

    A splits texts by the byte-level pattern, in which no match reaches over a blank between two other characters. B merges within
    what a blank begins if no piece has a blank behind another character, and rewrites nothing before.
    """
    from sentencepiece import sentencepiece_model_pb2

    with open(path_a) as file:
        layout = json.load(file)
    split = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    own = layout["pre_tokenizer"] or {}
    plain_a = layout["normalizer"] is None and all(own.get(k) == v for k, v in split.items()) and all(t["special"] for t in layout["added_tokens"])
    spec = sentencepiece_model_pb2.ModelProto.FromString(model_b).normalizer_spec
    plain_b = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces and spec.add_dummy_prefix
    return plain_a and plain_b and not any("▁" in p.lstrip("▁") for p in pieces_b)


class Encoders:
    """Both tokenizers, the bytes of their ids, the texts that digests are made of, and the tokens of the words met so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._b = SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        self.bytes_a = [b""] * self._a.get_vocab_size()
        for entry, i in self._a.get_vocab().items():
            known = all(c in letters for c in entry)
            self.bytes_a[i] = bytes(letters[c] for c in entry) if known else entry.encode()
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if len(pieces) > 1 << _SHIFT:
            raise ValueError("ids of the second tokenizer need more than 16 bits")
        self.size_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        # An id of A before another of its group, and as the last one; an id of B before another, as the last of a group, of a text.
        self.texts = [f"{i}{mark}".encode() for i in range(len(self.bytes_a)) for mark in (",", "|")]
        self.of_b = len(self.texts)
        self.texts += [f"{i}{mark}".encode() for i in range(len(pieces)) for mark in (",", ";", "")]
        self._cut = cuttable(path_a, self._b.serialized_model_proto(), pieces)
        self._forget()

    def _forget(self) -> None:
        self._words: dict[str, int] = {}  # number of a word, or LOOSE
        self._flat = [np.empty(0, dtype=np.int32)] * 2  # ids of the words one after the other, by A and by B
        self._sizes = [np.empty(0, dtype=np.int64)] * 2
        self._spelled = np.empty(0, dtype=bool)
        self._hits = np.empty(0, dtype=np.int64)

    def _shed(self) -> None:
        """Keep the words met most often, more than once, and at most half as many as fit."""
        half = WORDS // 2
        least = max(2, int(np.partition(self._hits, -half)[-half]) + 1) if len(self._hits) > half else 2
        kept = self._hits >= least
        number = np.cumsum(kept) - 1
        self._words = {word: int(number[i]) for word, i in self._words.items() if i != LOOSE and kept[i]}
        for side, sizes in enumerate(self._sizes):
            self._flat[side], self._sizes[side] = self._flat[side][np.repeat(kept, sizes)], sizes[kept]
        self._spelled, self._hits = self._spelled[kept], np.ones(int(kept.sum()), dtype=np.int64)

    def _meet(self, words: Iterable[str]) -> None:
        """Learn words that are new. Those with white space at an end are no words: the blank beside them is no place to cut."""
        fresh = []
        for word in words:
            if self._cut and (not word or word[0].isspace() or word[-1].isspace()):
                self._words[word] = LOOSE
            else:
                fresh.append(word)
        if fresh:
            self._learn(fresh)

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of words, and whether they spell a blank and the word."""
        plain = [w for w in words if self._cut and w and "▁" not in w and not w[0].isspace() and not w[-1].isspace()]
        # Words that are cut at the blanks before them need not be encoded one by one.
        found = self._in_rows(plain) if len(plain) >= ROW_WORDS else None
        if found:
            self._keep(plain, *found, np.ones(len(plain), dtype=bool))
            words = list(set(words).difference(plain))
        if not words:
            return
        whole = [f" {w}".encode() for w in words]
        lists = [e.ids for e in self._a.encode_batch_fast([f" {w}" for w in words], add_special_tokens=False)], self._b.encode(words, num_threads=1)
        spelled = np.ones(len(words), dtype=bool)
        sides = []
        for ids_of, table in zip(lists, (self.bytes_a, self.bytes_b), strict=True):
            spelled &= [b"".join(map(table.__getitem__, ids)) == w for ids, w in zip(ids_of, whole, strict=True)]
            n = np.array([len(ids) for ids in ids_of], dtype=np.int64)
            sides.append((np.fromiter(chain.from_iterable(ids_of), dtype=np.int32, count=int(n.sum())), n))
        self._keep(words, *sides, spelled)

    def _in_rows(self, words: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]] | None:
        """Ids of words and how many each has, by both; None unless rows of words are spelled, and every word ends with a token."""
        rows = [" ".join(words[k:k + ROW_WORDS]) for k in range(0, len(words), ROW_WORDS)]
        lengths = np.cumsum([len(w.encode()) + 1 for w in words])
        whole = b"".join(f" {row}".encode() for row in rows)
        sides = []
        for lists, table, sizes in (
            ([e.ids for e in self._a.encode_batch_fast([f" {row}" for row in rows], add_special_tokens=False)], self.bytes_a, self.size_a),
            (self._b.encode(rows, num_threads=1), self.bytes_b, self.size_b),
        ):
            flat = np.fromiter(chain.from_iterable(lists), dtype=np.int32)
            ends = np.cumsum(sizes[flat])
            last = np.searchsorted(ends, lengths)
            if not len(ends) or last[-1] >= len(ends) or not np.array_equal(ends[last], lengths):
                return None
            if b"".join(map(table.__getitem__, flat.tolist())) != whole:
                return None
            sides.append((flat, np.diff(last, prepend=-1)))
        return sides[0], sides[1]

    def _keep(self, words: list[str], a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], spelled: np.ndarray) -> None:
        known = len(self._spelled)
        self._words.update(zip(words, range(known, known + len(words)), strict=True))
        self._spelled = np.concatenate([self._spelled, spelled])
        self._hits = np.concatenate([self._hits, np.zeros(len(words), dtype=np.int64)])
        for side, (flat, n) in enumerate((a, b)):
            self._flat[side] = np.concatenate([self._flat[side], flat])
            self._sizes[side] = np.concatenate([self._sizes[side], n])

    def _joined(self, parts: list[str]) -> list[str]:
        """Parts of a text with those beside a loose one put together again."""
        out, before = [parts[0]], self._words[parts[0]] == LOOSE
        for part in parts[1:]:
            own = self._words[part] == LOOSE
            if before or own:
                out[-1] += " " + part
            else:
                out.append(part)
            before = own
        return out

    def _numbers(self, texts: list[str]) -> list[list[int]]:
        """Numbers of the words that make up each text."""
        known = self._words
        cut = [t.split(" ") if self._cut else [t] for t in texts]
        self._meet(set(chain.from_iterable(cut)).difference(known))
        out = [list(map(known.__getitem__, parts)) for parts in cut]
        loose = [i for i, numbers in enumerate(out) if LOOSE in numbers]
        if loose:
            joined = {i: self._joined(cut[i]) for i in loose}
            # What is left together is encoded whole, with white space at its ends if a text has it there.
            self._learn(list({w for parts in joined.values() for w in parts if known.get(w, LOOSE) == LOOSE}))
            for i, parts in joined.items():
                out[i] = list(map(known.__getitem__, parts))
            for word in [w for parts in joined.values() for w in parts if not w or w[0].isspace() or w[-1].isspace()]:
                known[word] = LOOSE  # for other texts it stands beside a blank
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts by both, and how many each text has; none where they do not spell a blank and the text."""
        if max(len(self._words), len(self._spelled)) > WORDS:
            self._shed()
        numbers = self._numbers(texts)
        count = np.array([len(x) for x in numbers])
        word = np.fromiter(chain.from_iterable(numbers), dtype=np.int64, count=int(count.sum()))
        self._hits += np.bincount(word, minlength=len(self._hits))
        first = np.cumsum(count) - count
        whole = np.logical_and.reduceat(self._spelled[word], first) & np.array([bool(t) for t in texts])
        word = word[np.repeat(whole, count)]
        out = []
        for flat, sizes in zip(self._flat, self._sizes, strict=True):
            n = sizes[word]
            starts = (np.cumsum(sizes) - sizes)[word]
            out.append(flat[np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())])
            per_text = np.zeros(len(texts), dtype=np.int64)
            if len(n):
                kept = count[whole]
                per_text[whole] = np.add.reduceat(n, np.cumsum(kept) - kept)
            out.append(per_text)
        return out[0], out[2], out[1], out[3]


@lru_cache(maxsize=2)
def encoders(path_a: str, path_b: str) -> Encoders:
    return Encoders(path_a, path_b)


def ranks_of(points: np.ndarray, marked: np.ndarray, size: int) -> np.ndarray:
    """How many of the ``marked`` offsets are smaller than each of ``points``; all are at most ``size``."""
    flags = np.zeros(size + 1, dtype=np.int8)
    flags[marked] = 1
    return (np.cumsum(flags, dtype=np.int32) - flags)[points]


def common_ends(ea: np.ndarray, eb: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Mask of the ends ``ea`` that are in ``eb`` as well; both ascend. first and last: places of each text's tokens, whose last ends are common."""
    shared = np.zeros(len(ea), dtype=bool)
    shared[last] = True
    low, high = first, last  # places not looked at yet; high is excluded
    while True:
        some = low < high
        low, high = low[some], high[some]
        if not len(low):
            return shared
        order = np.argsort(low)  # neighbours are looked up after each other
        low, high = low[order], high[order]
        middle = (low + high) >> 1
        cut, distance = np.full(len(low), -1), np.zeros(len(low), dtype=np.int64)
        looking, near, far = np.arange(len(low)), 0, 1
        while len(looking):  # at distances near to far from the middle, on both sides
            steps = np.arange(near, far)
            centre, floor, ceiling = middle[looking, None], low[looking, None], high[looking, None]
            sides = []
            for place in (centre + steps, centre - steps):
                inside = (place >= floor) & (place < ceiling)
                wanted = ea[np.where(inside, place, 0)]
                sides.append(inside & (eb[np.minimum(np.searchsorted(eb, wanted), len(eb) - 1)] == wanted))
            either = sides[0] | sides[1]
            at = either.argmax(axis=1)
            rows = np.arange(len(looking))
            hit = either[rows, at]
            right = sides[0][rows, at]
            chosen = looking[hit]
            distance[chosen] = steps[at[hit]]
            cut[chosen] = middle[chosen] + np.where(right[hit], 1, -1) * distance[chosen]
            looking, near, far = looking[~hit], far, 2 * far
            # A leaf has nothing left at this distance.
            looking = looking[(middle[looking] + near < high[looking]) | (middle[looking] - near >= low[looking])]
        found = cut >= 0
        low, high, middle, cut, distance = (x[found] for x in (low, high, middle, cut, distance))
        shared[cut] = True
        rightwards = cut >= middle
        # What was looked at and is not common needs no second look.
        left_high = np.where(rightwards, middle - distance + 1, cut)
        left_high = np.where(distance == 0, middle, left_high)
        low, high = np.concatenate([low, middle + distance + 1]), np.concatenate([left_high, high])


@dataclass
class Aligned:
    """Texts of a chunk: numbers of tokens, groups and links, digests, and the chunk's links and groups one after the other."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    links: np.ndarray
    ids_a: np.ndarray
    ids_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    cuts: np.ndarray


def align_texts(enc: Encoders, texts: list[str]) -> Aligned:
    a, b, n_a, n_b = enc.encode(texts)
    some = n_a > 0
    if not len(a):
        none = np.zeros(len(texts), dtype=np.int64)
        empty = np.empty(0, dtype=np.int64)
        return Aligned(n_a, n_b, none, none, [""] * len(texts), empty, a, b, empty, empty, empty)
    kind = np.int32 if sum(map(len, texts)) < 1 << 28 else np.int64  # smaller arrays are searched faster
    ea, eb = np.cumsum(enc.size_a[a], dtype=kind), np.cumsum(enc.size_b[b], dtype=kind)
    stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
    shared = common_ends(ea, eb, (stop_a - n_a)[some], stop_a[some] - 1)
    cuts = ea[shared]
    size = int(ea[-1])
    group_a, group_b = np.cumsum(shared) - shared, ranks_of(eb, cuts, size)
    ends = ea[stop_a[some] - 1]  # of texts
    n_groups = np.zeros(len(texts), dtype=np.int64)
    n_groups[some] = np.diff(np.searchsorted(cuts, ends, "right"), prepend=0)

    last_b = cuts[group_b] == eb
    points = np.sort(np.concatenate([ea, eb[~last_b]]), kind="stable")
    links = (a[ranks_of(points, ea, size)].astype(np.uint32) << _SHIFT) | b[ranks_of(points, eb, size)].astype(np.uint32)
    n_links = np.zeros(len(texts), dtype=np.int64)
    n_links[some] = np.diff(np.searchsorted(points, ends, "right"), prepend=0)

    # Digests: the ids of a group by A, then those by B.
    groups = np.arange(len(cuts))
    code = np.empty(len(a) + len(b), dtype=np.int32)
    code[np.arange(len(a)) + np.searchsorted(group_b, groups)[group_a]] = 2 * a + shared
    mark = last_b.astype(np.int64)
    mark[stop_b[some] - 1] = 2
    code[np.arange(len(b)) + np.searchsorted(group_a, groups, "right")[group_b]] = enc.of_b + 3 * b + mark
    text_of, digests, place = enc.texts.__getitem__, [], 0
    for n in (n_a + n_b).tolist():
        spelled = b"".join(map(text_of, code[place:place + n].tolist()))
        digests.append(hashlib.sha256(spelled).hexdigest() if n else "")
        place += n
    return Aligned(n_a, n_b, n_groups, n_links, digests, links, a, b, group_a, group_b, cuts)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], int]]:
    """doc_ids, texts and bytes of about CHUNK_BYTES at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text or "")
                size += len(texts[-1].encode())
                if size >= CHUNK_BYTES:
                    yield ids, texts, size
                    ids, texts, size = [], [], 0
    if ids:
        yield ids, texts, size


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Numbers in any order as sorted steps: a byte each, 255 where the step stands in the second part."""
    steps = np.diff(np.sort(numbers), prepend=0)
    return np.minimum(steps, 255).astype(np.uint8).tobytes(), steps[steps >= 255].astype("<u4").tobytes()


def unpack(small: bytes, wide: bytes) -> np.ndarray:
    steps = np.frombuffer(small, dtype=np.uint8).astype(np.int64)
    steps[steps == 255] = np.frombuffer(wide, dtype="<u4")
    return np.cumsum(steps)


_TEXTS = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, wide binary"
_BLOCKS = _TEXTS + ", pairs binary, sums binary"
_LAYOUT = pa.schema([
    *((c, pa.int64()) for c in ("block", "doc_id", "n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()),
    *((c, pa.binary()) for c in ("links", "wide", "pairs", "sums"))])


def _block(number: int, parts: list[tuple[list, Aligned]]) -> Iterator[pa.RecordBatch]:
    """Rows of a block's texts, and one with its pairs and their sums."""
    pairs, inverse, sums = np.unique(np.concatenate([x.links for _, x in parts]), return_inverse=True, return_counts=True)
    order = np.argsort(-sums, kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    places, start = rank[inverse], 0
    for ids, x in parts:
        packed = []
        for n in x.n_links.tolist():
            packed.append(pack(places[start:start + n]))
            start += n
        none = pa.nulls(len(ids), pa.binary())
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(ids), number)), pa.array(ids, pa.int64()), *map(pa.array, (x.n_a, x.n_b, x.n_groups, x.n_links)),
            pa.array(x.digests, pa.string()), pa.array([p for p, _ in packed], pa.binary()), pa.array([w for _, w in packed], pa.binary()),
            none, none], schema=_LAYOUT)
    if len(pairs):
        yield pa.RecordBatch.from_pylist(
            [{"block": number, "pairs": pairs[order].astype("<i8").tobytes(), "sums": sums[order].astype("<i8").tobytes()}], schema=_LAYOUT)


def _blocks(path_a: str, path_b: str, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoders(path_a, path_b)
        numbers = count(TaskContext.get().partitionId() << 32)
        parts, held = [], 0
        for ids, texts, size in _chunks(batches):
            parts.append((ids, align_texts(enc, texts)))
            held += size
            if held >= block_bytes:
                yield from _block(next(numbers), parts)
                parts, held = [], 0
        if parts:
            yield from _block(next(numbers), parts)
    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block, place, pair, n of the distinct pairs of every block."""
    for batch in batches:
        for block, pairs, sums in zip(*(batch[c].to_pylist() for c in ("block", "pairs", "sums")), strict=True):
            pair, n = np.frombuffer(pairs, dtype="<i8"), np.frombuffer(sums, dtype="<i8")
            for k in range(0, len(pair), ROWS):
                part = pair[k:k + ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), block)), pa.array(np.arange(k, k + len(part), dtype=np.int32)), pa.array(part), pa.array(n[k:k + ROWS])],
                    ["block", "place", "pair", "n"])


def _summed(texts: pa.Table, values: pa.Table) -> pa.Table:
    """Sums over each text's links. A value is twice a pair's count, and one more if it is best."""
    value = np.zeros(len(values), dtype=np.int64)
    value[values["place"].to_numpy()] = values["value"].to_numpy()
    total, best = value >> 1, value & 1
    sums = []
    for small, wide in zip(texts["links"].to_pylist(), texts["wide"].to_pylist(), strict=True):
        place = unpack(small, wide)
        sums.append((int(best[place].sum()), int(total[place].sum())))
    out = texts.drop_columns(["block", "links", "wide"])
    out = out.append_column("n_best", pa.array([s for s, _ in sums], pa.int64()))
    return out.append_column("count_sum", pa.array([s for _, s in sums], pa.int64()))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def align(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum of every row of doc_id and text."""
    ship(docs.sparkSession)
    blocks = keep(_texts(docs).mapInArrow(_blocks(path_a, path_b, block_bytes), _BLOCKS), "aligned")
    sent = blocks.where("pairs is not null").select("block", "pairs", "sums").mapInArrow(
        _pairs, "block long, place int, pair long, n long")
    counts = keep(sent.groupBy("pair").agg(F.sum("n").alias("n")), "counts")
    # One row per id of B: the vocabulary bounds it.
    highest = F.broadcast(counts.groupBy(F.expr(f"pair & {(1 << _SHIFT) - 1}").alias("b")).agg(F.max("n").alias("top")))
    values = counts.withColumn("b", F.expr(f"pair & {(1 << _SHIFT) - 1}")).join(highest, "b").select(
        "pair", F.expr("2 * n + if(n = top, 1, 0)").alias("value"))
    own = sent.select("block", "place", "pair").join(values.hint("merge"), "pair").select("block", "place", "value")
    texts = blocks.where("pairs is null").drop("pairs", "sums")
    layout = _TEXTS.replace("block long, ", "").replace(", links binary, wide binary", "") + ", n_best long, count_sum long"
    return texts.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(_summed, layout)


def pair_counts(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """a_id, b_id, n: how many links of the corpus hold the ids linked."""
    ship(docs.sparkSession)
    blocks = _texts(docs).mapInArrow(_blocks(path_a, path_b, block_bytes), _BLOCKS)
    sent = blocks.where("pairs is not null").select("block", "pairs", "sums").mapInArrow(_pairs, "block long, place int, pair long, n long")
    return sent.groupBy("pair").agg(F.sum("n").alias("n")).select(
        F.expr(f"cast(shiftright(pair, {_SHIFT}) as int) as a_id"), F.expr(f"cast(pair & {(1 << _SHIFT) - 1} as int) as b_id"), "n")


def _group_rows(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoders(path_a, path_b)
        for ids, texts, _ in _chunks(batches):
            x = align_texts(enc, texts)
            owner = np.repeat(np.arange(len(ids)), x.n_groups)
            base = np.concatenate([[0], np.cumsum([len(t.encode()) + 1 if n else 0 for t, n in zip(texts, x.n_groups, strict=True)])])
            starts = np.concatenate([[0], x.cuts[:-1]]) if len(x.cuts) else x.cuts
            places = [np.concatenate([np.searchsorted(g, np.arange(len(x.cuts))), [len(g)]]).astype(np.int32) for g in (x.group_a, x.group_b)]
            lists = [pa.ListArray.from_arrays(pa.array(p), pa.array(i.astype(np.int32)))
                     for p, i in zip(places, (x.ids_a, x.ids_b), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in owner.tolist()], pa.int64()), pa.array(starts - base[owner]), pa.array(x.cuts - base[owner]), *lists],
                ["doc_id", "start", "end", "a_ids", "b_ids"])
    return run


def aligned_groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, start, end (bytes of a blank and the text), a_ids, b_ids: one row per group."""
    ship(docs.sparkSession)
    return _texts(docs).mapInArrow(
        _group_rows(path_a, path_b), "doc_id long, start long, end long, a_ids array<int>, b_ids array<int>")
