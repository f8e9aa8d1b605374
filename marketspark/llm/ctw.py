"""Language-model scores by context-tree weighting over bytes.

A byte is coded as eight binary decisions; a decision's node is the bits before it in the byte. For every node there is a tree of
contexts: the last 0 to ``DEPTH`` bytes. Each context has a Krichevsky-Trofimov estimate of the decision from training counts, and the
weighted probability of a context is half its own estimate and half the product of those of the contexts one byte longer. From the
trained tree follows how much each depth counts on the way from the root; a text is scored by those mixtures. Contexts that training never
met end the way: their parent's estimate stands for them. A text ends in a zero byte, which is scored too, and begins after ``DEPTH`` zero bytes.

All is derived from counts of strings of DEPTH + 1 bytes over all documents. Tasks run through their texts a part at a time, gather them into blocks of bounded size, and keep,
beside the packed texts, each block's distinct strings with their training counts, packed per bucket. A bucket holds whole subtrees from depth ``SPLIT`` on. Spark brings the packed
strings of a bucket together, a task adds them up one block after the other, and contexts are weighted in buckets; the at most 256 ** SPLIT contexts above are summed by Spark. Then the blocks' strings
meet their bucket's values, again one block after the other, and go back to their block, where the texts are scored. Only packed rows move, never one per string. Words travel
as 63-bit hashes in the same rows.

Defined cases: a null text is an empty one and has only its end. A null doc_id is scored, and held out or not by the CRC of the empty string. Without training
documents all estimates are even, and N and V are 0: the base score is then 0. Long texts are taken in slices that overlap by a context. Repeated rows count each. An empty table gives an empty result.
Only doc_id and text are read, so clashing columns do not matter.
"""

from __future__ import annotations

import io
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.ipc  # noqa: F401
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import keep, ship
from marketspark.llm.toxicity import remainder

DEPTH, SPLIT = 5, 3
BLOCK_BYTES = 24 << 20
SLICE = 1 << 20
ROWS = 256  # of a part
MERGED = 1_000_000  # strings gathered before they are summed
BUCKET_BYTES, BUCKETS = 8 << 20, 1 << 16  # texts that one more bucket is made for; buckets at most
_SPREAD, _LOW = 2654435769, (1 << 32) - 1  # spread contexts, below 2 ** 24, over the buckets
_WORD_BIT = -(1 << 63)


def lgamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after eight steps of the recurrence; x > 0."""
    product = np.ones_like(x)
    for k in range(8):
        product *= x + k
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(product)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of a zeros and b ones."""
    half = 0.5
    # Counts this large are followed by their ratio: the product in lgamma would overflow.
    big = np.maximum(a, b) > 1e30
    assert not big.any()
    return lgamma(a + half) + lgamma(b + half) - math.log(math.pi) - lgamma(a + b + 1)


def weigh(le: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability of contexts, and the share of their own estimate in it."""
    top = np.maximum(le, below)
    mixed = top + np.log(0.5 * np.exp(le - top) + 0.5 * np.exp(below - top))
    return mixed, 1 / (1 + np.exp(np.clip(below - le, -700, 700)))


def strings(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Every string of depth + 1 bytes that ends in a byte of a text or its end, packed into longs; and how many each text has."""
    size = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    pad = bytes(depth)
    flat = np.frombuffer(pad + (b"\0" + pad).join(texts) + b"\0", dtype=np.uint8).astype(np.int64)
    packed = np.zeros(len(flat) - depth, dtype=np.int64)
    for k in range(depth + 1):
        packed = (packed << 8) | flat[k:k + len(packed)]
    first = np.cumsum(size + depth) - size - depth
    valid = np.ones(len(packed) + depth, dtype=np.int8)
    for k in range(depth):  # strings that end in the padding of the next text
        valid[first + size + k] = 0
    return packed[valid[:len(packed)].astype(bool)], size


def _slices(text: bytes, depth: int) -> Iterator[tuple[np.ndarray, int]]:
    """The strings of one text, in parts of bounded size."""
    whole = bytes(depth) + text + b"\0"
    for k in range(0, len(text) + 1, SLICE):
        part = np.frombuffer(whole[k:k + SLICE + depth], dtype=np.uint8).astype(np.int64)
        packed = np.zeros(len(part) - depth, dtype=np.int64)
        for j in range(depth + 1):
            packed = (packed << 8) | part[j:j + len(packed)]
        yield packed


def _packed(texts: list[bytes], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Strings, the places of their texts' first ones, and the texts' indices; several short texts or a part of a long one at a time."""
    group, index, size = [], [], 0
    for i, text in enumerate(texts):
        if len(text) > SLICE:
            for packed in _slices(text, depth):
                yield packed, np.array([0]), np.array([i])
            continue
        group.append(text)
        index.append(i)
        size += len(text)
        if size >= SLICE:
            packed, sizes = strings(group, depth)
            yield packed, np.cumsum(sizes) - sizes, np.array(index)
            group, index, size = [], [], 0
    if group:
        packed, sizes = strings(group, depth)
        yield packed, np.cumsum(sizes) - sizes, np.array(index)


def words_of(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased, cut at the six ASCII white spaces."""
    return text.lower().split()


def word_key(word: bytes) -> int:
    """A negative long; the end of a text is the empty word."""
    return (xxhash.xxh3_64_intdigest(word) >> 1) + _WORD_BIT


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    unique, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return unique, np.bincount(inverse, np.concatenate(counts), len(unique)).astype(np.int64)


def pack(numbers: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(numbers).tobytes(), 1)


def unpack(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype=kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys, by their steps."""
    return pack(np.diff(keys, prepend=0))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.int64))


def look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of keys, all of which are there. Looked up in their order, as neighbours then lie close together in memory."""
    order = np.argsort(wanted)
    out = np.empty(len(wanted), dtype=values.dtype)
    out[order] = values[np.searchsorted(keys, wanted[order])]
    return out


def bucket_of(keys: np.ndarray, split: int, buckets: int) -> np.ndarray:
    """Strings by their context at ``split``, words by their hash."""
    context = (keys >> 8) & ((1 << (8 * split)) - 1)
    return np.where(keys < 0, (keys - _WORD_BIT) >> 16, ((context * _SPREAD) & _LOW) >> 8) % buckets


def bucket_of_context(split: int, buckets: int) -> str:
    """The same in SQL, of a column ``context``."""
    return f"pmod(shiftright((context * {_SPREAD}L) & {_LOW}L, 8), {buckets}L)"


def bucket_tasks(buckets: int, cores: int) -> int:
    """Tasks that work through the buckets: four buckets each, which come one after the other, but enough tasks for the cores.

    They grow in number with the texts, not in size. Each writes a file, and Spark's writer on a local disk starts
    a process for every file, so there are no more of them than that.
    """
    return max(math.ceil(buckets / 4), min(buckets, 3 * cores))


_PART = ["doc_id", "held_out", "text"]
_BLOCK = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("texts", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary())])


def _pack_part(part: pa.RecordBatch) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write(part)
    return out.getvalue()


class _Counts:
    """Distinct strings and words of a block, with their numbers in training texts."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.words: Counter[bytes] = Counter()

    def add(self, texts: list[bytes], held_out: bool, depth: int) -> None:
        for packed, _, _ in _packed(texts, depth):
            unique, n = np.unique(packed, return_counts=True)
            self.keys.append(unique)
            self.counts.append(n * (not held_out))
            if sum(map(len, self.keys)) > MERGED + len(self.keys[0]):
                key, n = _summed(self.keys, self.counts)
                self.keys, self.counts = [key], [n]
        for text in texts:
            if held_out:
                for word in {b"", *words_of(text)}:
                    self.words.setdefault(word, 0)
            else:
                self.words.update(words_of(text))
                self.words[b""] += 1

    def rows(self, block: int, split: int, buckets: int) -> Iterator[pa.RecordBatch]:
        self.keys.append(np.fromiter(map(word_key, self.words), dtype=np.int64, count=len(self.words)))
        self.counts.append(np.fromiter(self.words.values(), dtype=np.int64, count=len(self.words)))
        keys, n = _summed(self.keys, self.counts)
        bucket = bucket_of(keys, split, buckets)
        order = np.argsort(bucket, kind="stable")  # keys ascend within a bucket
        keys, n, bucket = keys[order], n[order], bucket[order]
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        stops = np.append(starts[1:], len(keys))
        for k in range(0, len(starts), 1000):
            some = list(zip(starts[k:k + 1000].tolist(), stops[k:k + 1000].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(some), block)), pa.array(bucket[starts[k:k + 1000]]), pa.nulls(len(some), pa.binary()),
                pa.array([pack_keys(keys[a:b]) for a, b in some], pa.binary()), pa.array([pack(n[a:b]) for a, b in some], pa.binary())], schema=_BLOCK)


def _blocks(depth: int, split: int, buckets: int):
    """Packed texts of blocks, a part a row, and their strings, a bucket a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts, size = TaskContext.get().partitionId() << 32, _Counts(), 0
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS).select(_PART)
                held, texts = part["held_out"].to_pylist(), [t.encode() for t in part["text"].to_pylist()]
                for held_out in (False, True):
                    counts.add([t for t, h in zip(texts, held, strict=True) if h == held_out], held_out, depth)
                yield pa.RecordBatch.from_pylist([{"block": block, "bucket": -1, "texts": _pack_part(part)}], schema=_BLOCK)
                size += sum(map(len, texts))
                if size >= BLOCK_BYTES:
                    yield from counts.rows(block, split, buckets)
                    block, counts, size = block + 1, _Counts(), 0
        if counts.words:
            yield from counts.rows(block, split, buckets)
    return run


_MERGED = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("tokens", pa.int64()), ("words", pa.int64())])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket: the sums over all blocks. Rows come sorted by bucket."""
    def row() -> pa.RecordBatch:
        key, n = _summed(keys, counts)
        words = n[key < 0]
        return pa.RecordBatch.from_pylist([{
            "bucket": bucket, "keys": pack_keys(key), "counts": pack(n), "tokens": int(words.sum()), "words": int((words > 0).sum())}], schema=_MERGED)

    bucket, keys, counts = None, [], []
    for batch in batches:
        for own, key, n in zip(*(batch[c] for c in ("bucket", "keys", "counts")), strict=True):
            if own.as_py() != bucket:
                if keys:
                    yield row()
                bucket, keys, counts = own.as_py(), [], []
            keys.append(unpack_keys(key.as_py()))
            counts.append(unpack(n.as_py(), np.int64))
            if sum(map(len, keys)) > MERGED + len(keys[0]):
                key, n = _summed(keys, counts)
                keys, counts = [key], [n]
    if keys:
        yield row()


def _levels(key: np.ndarray, n: np.ndarray, bit: int, depths: range):
    """For one decision: per depth its nodes, each string's node, and the nodes' counts of zeros and ones."""
    byte = key & 255
    before, one = byte >> (8 - bit), (byte >> (7 - bit)) & 1
    out = []
    for depth in depths:
        context = (key >> 8) & ((1 << (8 * depth)) - 1)
        node, inverse = np.unique((context << bit) | before, return_inverse=True)
        out.append((node, inverse, np.bincount(inverse, n * (1 - one), len(node)), np.bincount(inverse, n * one, len(node))))
    return one, out


def _weights(levels: list) -> tuple[list[np.ndarray], np.ndarray]:
    """Own shares of the nodes of each depth (shallowest first), and the log weighted probability of the shallowest."""
    shares, below = [], None
    for depth in range(len(levels) - 1, -1, -1):
        node, inverse, a, b = levels[depth]
        le = estimate(a, b)
        if below is None:
            mixed, share = le, np.ones(len(node))
        else:
            deeper = levels[depth + 1]
            some = np.empty(len(deeper[0]), dtype=np.int64)
            some[deeper[1]] = np.arange(len(deeper[1]))
            mixed, share = weigh(le, np.bincount(inverse[some], below, len(node)))
        shares.insert(0, share)
        below = mixed
    return shares, below


def subtree_nodes(key: np.ndarray, n: np.ndarray, split: int, depth: int) -> dict[str, np.ndarray]:
    """context, node (its bits behind a leading 1), zeros, ones and log weighted probability of the nodes at depth ``split``."""
    out = {"context": [], "node": [], "zeros": [], "ones": [], "lw": []}
    for bit in range(8):
        _, levels = _levels(key, n, bit, range(split, depth + 1))
        _, lw = _weights(levels)
        node, _, a, b = levels[0]
        out["context"].append(node >> bit)
        out["node"].append((node & ((1 << bit) - 1)) | (1 << bit))
        out["zeros"].append(a)
        out["ones"].append(b)
        out["lw"].append(lw)
    return {k: np.concatenate(v) for k, v in out.items()}


def string_logs(key: np.ndarray, n: np.ndarray, above: dict[str, np.ndarray], split: int, depth: int) -> np.ndarray:
    """log10 probability of each string's last byte. ``above`` has, per context at ``split`` and node, what the depths above make of a
    zero (low) and a one (high), the weight that is left, and the estimate of a zero by the deepest context met there."""
    order = np.argsort((above["context"] << 8) | above["node"])
    place = ((above["context"] << 8) | above["node"])[order]
    total = np.zeros(len(key))
    for bit in range(8):
        one, levels = _levels(key, n, bit, range(split, depth + 1))
        shares, _ = _weights(levels)
        node = levels[0][0]
        own = order[np.searchsorted(place, ((node >> bit) << 8) | (node & ((1 << bit) - 1)) | (1 << bit))]
        inverse = levels[0][1]
        fixed = np.where(one == 1, above["high"][own][inverse], above["low"][own][inverse])
        left = above["rest"][own][inverse]
        zero = above["zero"][own][inverse]
        last = np.where(one == 1, 1 - zero, zero)
        for (_, inverse, a, b), share in zip(levels, shares, strict=True):
            seen = (a + b)[inverse] > 0
            kt = (np.where(one == 1, b[inverse], a[inverse]) + 0.5) / ((a + b)[inverse] + 1)
            last = np.where(seen, kt, last)
            own_share = np.where(seen, share[inverse], 1.0)
            fixed = fixed + left * own_share * last
            left = left * (1 - own_share)
        total += np.log10(fixed)
    return total


_NODES = "context long, node long, zeros double, ones double, lw double"


def _nodes_of(split: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch["keys"], batch["counts"], strict=True):
                key, n = unpack_keys(keys.as_py()), unpack(counts.as_py(), np.int64)
                some = key >= 0
                if some.any():
                    yield pa.RecordBatch.from_pydict(subtree_nodes(key[some], n[some].astype(float), split, depth))
    return run


def _logs_of(split: int, depth: int):
    """One row per bucket: its keys and their values, logarithms of strings and counts of words."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        above = {c: right[c].to_numpy() for c in ("context", "node", "low", "high", "rest", "zero")}
        rows = []
        for row in left.to_pylist():
            key, n = unpack_keys(row["keys"]), unpack(row["counts"], np.int64).astype(float)
            some = key >= 0
            value = n.copy()
            if some.any():
                value[some] = string_logs(key[some], n[some], above, split, depth)
            rows.append({"bucket": row["bucket"], "keys": row["keys"], "values": pack(value)})
        return pa.Table.from_pylist(rows, schema=pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("values", pa.binary())]))
    return run


_ANSWERS = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("values", pa.binary())])


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The values of each block's strings. Per bucket the row with all its values comes first."""
    known, value = np.empty(0, dtype=np.int64), np.empty(0)
    for batch in batches:
        for block, keys, values in zip(*(batch[c] for c in ("block", "keys", "values")), strict=True):
            if block.as_py() is None:
                known, value = unpack_keys(keys.as_py()), unpack(values.as_py(), np.float64)
                continue
            own = value[np.searchsorted(known, unpack_keys(keys.as_py()))]
            yield pa.RecordBatch.from_pylist([{"block": block.as_py(), "keys": keys.as_py(), "values": pack(own)}], schema=_ANSWERS)


def _weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, below = (batch[c].to_numpy() for c in ("zeros", "ones", "below"))
        lw, share = weigh(estimate(a, b), below)
        yield pa.RecordBatch.from_arrays(
            [batch["context"], batch["node"], batch["zeros"], batch["ones"], pa.array(lw), pa.array(share)],
            ["context", "node", "zeros", "ones", "lw", "share"])


def _upper(nodes: DataFrame, split: int) -> DataFrame:
    """Per context at ``split`` and node: low, high, rest, zero, as :func:`string_logs` needs them."""
    levels, now = [], nodes
    for depth in range(split - 1, -1, -1):
        shorter = now.groupBy((F.col("context").bitwiseAND((1 << (8 * depth)) - 1)).alias("context"), "node").agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("lw").alias("below"))
        now = keep(shorter.mapInArrow(_weighed, _NODES + ", share double"), "contexts")
        levels.insert(0, now)
    chain = levels[0].select("node", *(F.lit(v).alias(c) for c, v in (("low", 0.0), ("high", 0.0), ("rest", 1.0), ("zero", 0.5)))).withColumn(
        "context", F.lit(0).cast("bigint"))
    for depth in range(split + 1):
        if depth:  # hand down to the contexts one byte longer
            longer = (levels[depth] if depth < split else nodes).select("context", "node").withColumn(
                "parent", F.col("context").bitwiseAND((1 << (8 * (depth - 1))) - 1))
            up = chain.withColumnRenamed("context", "parent")
            chain = longer.join(up, ["parent", "node"]).drop("parent")
        if depth < split:
            own = levels[depth].select("context", "node", "zeros", "ones", "share")
            met = chain.join(own, ["context", "node"])
            share = "if(zeros + ones > 0, share, 1D)"
            zero = "if(zeros + ones > 0, (zeros + 0.5D) / (zeros + ones + 1), zero)"
            chain = met.select(
                "context", "node", F.expr(f"low + rest * {share} * {zero}").alias("low"),
                F.expr(f"high + rest * {share} * (1 - {zero})").alias("high"), F.expr(f"rest * (1 - {share})").alias("rest"),
                F.expr(zero).alias("zero"))
    return chain


def model_of(merged: DataFrame, buckets: int, depth: int, split: int) -> DataFrame:
    """bucket, keys and values: log10 probability of the last byte of every string, from the training counts in ``merged``."""
    nodes = keep(merged.select("keys", "counts").mapInArrow(_nodes_of(split, depth), _NODES), "nodes")
    upper = _upper(nodes, split).withColumn("bucket", F.expr(bucket_of_context(split, buckets)))
    return merged.select("bucket", "keys", "counts").groupBy("bucket").cogroup(upper.groupBy("bucket")).applyInArrow(
        _logs_of(split, depth), "bucket long, keys binary, values binary")


def values_of(counts: DataFrame, depth: int = DEPTH, split: int = SPLIT) -> DataFrame:
    """key and value: log10 probability of the last byte of every string, from the strings' training counts (key, n)."""
    def one(table: pa.Table) -> pa.Table:
        key, n = _summed([table["key"].to_numpy()], [table["n"].to_numpy()])
        return pa.table({"bucket": [0], "keys": [pack_keys(key)], "counts": [pack(n)]})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, values in zip(batch["keys"], batch["values"], strict=True):
                yield pa.RecordBatch.from_pydict({"key": unpack_keys(keys.as_py()), "value": unpack(values.as_py(), np.float64)})

    ship(counts.sparkSession)
    merged = keep(counts.withColumn("bucket", F.lit(0)).groupBy("bucket").applyInArrow(one, "bucket long, keys binary, counts binary"), "counts")
    return model_of(merged, 1, depth, split).select("keys", "values").mapInArrow(rows, "key long, value double")


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long"


def _score(depth: int, scale: float):
    def run(parts: pa.Table, answers: pa.Table) -> pa.Table:
        key = np.concatenate([unpack_keys(k.as_py()) for k in answers["keys"]])
        value = np.concatenate([unpack(v.as_py(), np.float64) for v in answers["values"]])
        order = np.argsort(key)
        key, value = key[order], value[order]
        logs_of: dict[bytes, float] = {}  # of the block's words that training met; the others share one value
        unknown = math.log10(0.5 / scale) if scale else 0.0
        ids, held, tokens, met, bases, scores, sizes = [], [], [], [], [], [], []
        for packed_part in parts["texts"]:
            part = pa.ipc.open_stream(packed_part.as_py()).read_all()
            texts = [t.encode() for t in part["text"].to_pylist()]
            own = np.zeros(len(texts))
            for packed, first, index in _packed(texts, depth):
                own[index] += np.add.reduceat(look_up(key, value, packed), first)
            ids += part["doc_id"].to_pylist()
            held += part["held_out"].to_pylist()
            scores += own.tolist()
            cut = [[*words_of(t), b""] for t in texts]
            fresh = [w for w in set().union(*cut) if w not in logs_of]
            counts = look_up(key, value, np.fromiter(map(word_key, fresh), dtype=np.int64, count=len(fresh)))
            logs_of.update((w, math.log10((c + 0.5) / scale)) for w, c in zip(fresh, counts.tolist(), strict=True) if c > 0)
            for text, words in zip(texts, cut, strict=True):
                known = [x for x in map(logs_of.get, words) if x is not None]
                tokens.append(len(words))
                met.append(len(known))
                bases.append(math.fsum(known) + unknown * (len(words) - len(known)))
                sizes.append(len(text))
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(held, pa.bool_()),
            "n_tokens": pa.array(tokens, pa.int64()), "n_known": pa.array(met, pa.int64()), "base_score": pa.array(bases, pa.float64()),
            "score": pa.array(scores, pa.float64()), "n_bytes": pa.array(sizes, pa.int64()),
        })
    return run


def score(docs: DataFrame, depth: int = DEPTH, split: int = SPLIT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and code_length (bits per byte, the end counted as one) of every row.

    Learns from rows whose crc32(doc_id as text) mod 5 is not 1. Contexts at ``split`` have at most 24 bits.
    """
    ship(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = min(BUCKETS, max(1, math.ceil(total / BUCKET_BYTES)))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (remainder(F.col("doc_id").cast("long")) == 1).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Partitions are joined, not cut, so that a block is large and its strings are sent once.
    joined = rows.coalesce(max(1, math.ceil(total / BLOCK_BYTES)))
    blocks = keep(joined.mapInArrow(
        _blocks(depth, split, buckets), "block long, bucket long, texts binary, keys binary, counts binary"), "blocks")
    sent = blocks.where("bucket >= 0")
    by_bucket = bucket_tasks(buckets, docs.sparkSession.sparkContext.defaultParallelism)
    by_block = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BLOCK_BYTES))
    merged = keep(sent.select("bucket", "keys", "counts").repartition(by_bucket, "bucket").sortWithinPartitions("bucket").mapInArrow(
        _merged, "bucket long, keys binary, counts binary, tokens long, words long"), "counts")
    tokens = merged.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("v")).first()
    scale = tokens["n"] + 0.5 * (tokens["v"] + 1) if tokens["n"] else 0.0
    model = model_of(merged, buckets, depth, split).selectExpr("bucket", "cast(null as bigint) as block", "keys", "values")
    asked = model.unionByName(sent.selectExpr("bucket", "block", "keys", "cast(null as binary) as values"))
    answers = asked.repartition(by_bucket, "bucket").sortWithinPartitions("bucket", F.asc_nulls_first("block")).select(
        "block", "keys", "values").mapInArrow(_answers, "block long, keys binary, values binary")
    texts = blocks.where("bucket < 0").select("block", "texts").repartition(by_block, "block")
    scored = texts.groupBy("block").cogroup(answers.repartition(by_block, "block").groupBy("block")).applyInArrow(
        _score(depth, float(scale)), _SCORES)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens["n"]).cast("bigint").alias("train_tokens"), "base_score", "score",
        (-F.col("score") / math.log10(2) / (F.col("n_bytes") + 1)).alias("code_length"))
