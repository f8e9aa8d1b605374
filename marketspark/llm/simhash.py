"""SimHash near-duplicates through an inverted index of byte positions.

A fingerprint is 8 bytes. Two that differ in at most d bits differ in at most d bytes, so at least 8 - d of their
positional bytes agree. The index posts every distinct fingerprint under small sets of (position, byte); the sets are chosen
so that any 8 - d agreeing positions hold one of them. Two fingerprints that meet in a list are a pair; its agreeing
positional bytes are tallied, pairs below 8 - d are dropped, and the rest is verified by bit distance.

Lists longer than ``LONG`` are not paired. Their fingerprints go another exact way: each is
posted under every value within d/2 flipped bits, and all that meet at a value are linked to the least of them. Two fingerprints
are within d bits exactly if they meet so. That takes rows in proportion to the fingerprints, not to their pairs.

All joins here are sort-merge joins by hint: every side grows with the documents, and Spark's size estimate knows neither
the fan-out of an explode nor how far a stored table is compressed, so it would broadcast them.

Defined cases: a null or empty text, or one of white space only, has fingerprint 0 and is linked like any other. Texts
of fewer words than the shingle have one shingle. Very long texts are summed in slices. Repeated rows and
equal fingerprints are one node. A null doc_id never names a component, unless all of its are null. An empty table gives an empty
result. Columns of the input that clash with the result's names are replaced by them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.llm.common import discard, keep, ship
from marketspark.llm.components import components

SEED = 42
LONG = 64
_SLICE = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits as a signed number: a bit is 1 if it is set in over half of the shingles' hashes."""
    words = (text or "").encode().lower().split()  # of bytes: only A-Z, and only the six ASCII white spaces
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    span = min(shingle, len(words))
    stops = (ends[span - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=False)], dtype=">u8")
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), _SLICE):
        counts += np.unpackbits(hashes[k:k + _SLICE].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True)


def _fingerprints(shingle: int, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py(), shingle) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(prints, pa.int64())], [*kept, "fingerprint"])
    return run


def fingerprints(df: DataFrame, shingle: int, *columns: str) -> DataFrame:
    """``columns`` of ``df`` and ``fingerprint``, a long, of the column text."""
    ship(df.sparkSession)
    kept = [c for c in columns if c != "fingerprint"]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("fingerprint", T.LongType())])
    return df.select(*dict.fromkeys([*kept, "text"])).mapInArrow(_fingerprints(shingle, kept), schema)


def posting_sets(max_bits: int) -> list[tuple[int, ...]]:
    """Position sets such that any 8 - max_bits positions hold one of them; greedily few."""
    if not 0 <= max_bits <= 7:
        raise ValueError("at least one byte must be sure to agree")
    open_sets = list(combinations(range(8), 8 - max_bits))
    size, chosen = min(3, 8 - max_bits), []
    while open_sets:
        best = max(combinations(range(8), size), key=lambda c: sum(set(c) <= set(o) for o in open_sets))
        chosen.append(best)
        open_sets = [o for o in open_sets if not set(best) <= set(o)]
    return chosen


def flips(bits: int) -> list[int]:
    """All 64-bit masks of at most so many bits, as signed numbers."""
    masks = [sum(1 << b for b in c) for n in range(bits + 1) for c in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links a, b between the distinct values of ``fingerprint``; their components are those of all pairs within max_bits."""
    byte = lambda i: f"(shiftrightunsigned(fingerprint, {8 * i}) & 255)"
    keys = []
    for number, chosen in enumerate(posting_sets(max_bits)):
        value = str(number)
        for i in chosen:
            value = f"(({value}) * 256 + {byte(i)})"
        keys.append(f"cast({value} as bigint)")
    posts = prints.select("fingerprint").distinct().select(
        "fingerprint", F.explode(F.expr(f"array({', '.join(keys)})")).alias("post"))
    sizes = posts.groupBy("post").agg(F.count("*").alias("n")).where("n > 1")
    shared = keep(posts.join(sizes.hint("merge"), "post"), "posts")

    short = shared.where(F.col("n") <= LONG)
    left = short.select("post", F.col("fingerprint").alias("a"))
    right = short.select("post", F.col("fingerprint").alias("b"))
    differing = "(a ^ b)"
    tally = " + ".join(f"if((shiftrightunsigned({differing}, {8 * i}) & 255) = 0, 1, 0)" for i in range(8))
    pairs = left.join(right.hint("merge"), "post").where(
        f"a < b and {tally} >= {8 - max_bits} and bit_count({differing}) <= {max_bits}").select("a", "b").distinct()

    # Values within half the bits (near) and, for odd numbers, one bit more: a near and any other are within max_bits.
    near = len(flips(max_bits // 2))
    masks = flips((max_bits + 1) // 2)
    spread = shared.where(F.col("n") > LONG).select("fingerprint").distinct()
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = spread.repartition(parts).select(
        F.col("fingerprint").alias("a"),
        F.posexplode(F.expr(f"array({', '.join(f'cast({m} as bigint)' for m in masks)})")).alias("number", "mask"),
    ).select("a", F.expr("a ^ mask").alias("value"), (F.col("number") < near).alias("near"))
    hubs = at.where("near").groupBy("value").agg(F.min("a").alias("b"))
    return pairs.unionByName(at.hint("merge").join(hubs, "value").where("a <> b").select("a", "b").distinct())


def groups(prints: DataFrame, max_bits: int) -> DataFrame:
    """``fingerprint`` and ``root`` of every distinct fingerprint; root is the same within a component."""
    found = components(links(prints, max_bits)).withColumnRenamed("node", "fingerprint")
    alone = prints.select("fingerprint").distinct()
    return alone.join(found.hint("merge"), "fingerprint", "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def label(prints: DataFrame, max_bits: int) -> DataFrame:
    """fingerprint and component_id, the least doc_id of the component, from rows of doc_id and fingerprint."""
    firsts = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    rooted = groups(prints, max_bits).join(firsts.hint("merge"), "fingerprint")
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(ids.hint("merge"), "root").select("fingerprint", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint as 16 hex digits, component_id of every row of doc_id and text."""
    prints = keep(fingerprints(docs, shingle, "doc_id"), "prints")
    return prints.join(label(prints, max_bits).hint("merge"), "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` with the least doc_id of each component, one row a component; nulls come last."""
    names = docs.columns
    marked = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), F.col("text"))
    stored = keep(
        fingerprints(marked, shingle, *(f"c{i}" for i in range(len(names)))).withColumn(
            "row", F.monotonically_increasing_id()), "rows")
    doc_id = F.col(f"c{names.index('doc_id')}")
    first = F.min(F.struct(doc_id.isNull().alias("none"), doc_id.alias("doc_id"), F.col("row"))).alias("first")
    firsts = stored.groupBy("fingerprint").agg(first)
    chosen = groups(stored, max_bits).join(firsts.hint("merge"), "fingerprint").groupBy("root").agg(F.min("first").alias("first"))
    kept = stored.join(chosen.select(F.col("first.row").alias("row")).hint("merge"), "row", "left_semi")
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
