"""Sharding by jump consistent hashing, in Spark's own expressions only.

Jump consistent hashing (Lamping and Veach, 2014) walks from shard to shard with the draws of a 64-bit linear
congruential generator seeded by the key. There is no ring table: key and shard count decide, and one more shard
takes rows from every other shard and moves none between old ones. The generator's products do not fit a signed
64-bit number, so its state is kept as two halves of 32 bits.

Defined cases: a null key counts as key 0. Keys that are not whole numbers enter by their XXH64. Repeated rows
share a shard and get slots of their own. Null and empty texts have size ``overhead``. An empty table gives an
empty result. Columns other than the key are never looked at, so clashing names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import keep

# Fixed value: the multiplier of the published generator; its increment is 1.
MULTIPLIER = 2862933555777941757

_MASK = 0xFFFFFFFF
_STEPS = 16  # most keys end within these; the others walk on, as far as they need


def _next(hi: str, lo: str) -> tuple[str, str]:
    """SQL of the generator's next state, from halves of 32 bits each, without a product over 2^49."""
    c_hi, c_lo = MULTIPLIER >> 32, MULTIPLIER & _MASK
    high, low = (lambda c: c >> 16), (lambda c: c & 0xFFFF)
    sum_lo = f"({lo} * {low(c_lo)} + (({lo} * {high(c_lo)} & 65535) << 16) + 1)"

    def modulo(half: str, c: int) -> str:
        return f"{half} * {low(c)} + (({half} * {high(c)} & 65535) << 16)"

    new_hi = f"(({sum_lo} >> 32) + ({lo} * {high(c_lo)} >> 16) + {modulo(hi, c_lo)} + {modulo(lo, c_hi)}) & {_MASK}"
    return f"({new_hi})", f"({sum_lo} & {_MASK})"


def _state(hi: str, lo: str, shard: str) -> str:
    new_hi, new_lo = _next(hi, lo)
    return f"named_struct('hi', {new_hi}, 'lo', {new_lo}, 'shard', {shard})"


def _jump(s: str) -> str:
    return f"cast(floor(({s}.shard + 1) * (2147483648D / (({s}.hi >> 1) + 1))) as bigint)"


def _walk(start: str, shards: int, steps: int) -> str:
    step = f"(s, i) -> if({_jump('s')} < {shards}, {_state('s.hi', 's.lo', _jump('s'))}, s)"
    return f"aggregate(sequence(1, {steps}), {start}, {step})"


def assign(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Add ``shard``, and ``grown_shard``: the shard with one shard more. Both replace columns of those names."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    kind = df.schema[key].dataType.typeName()
    whole = kind in ("byte", "short", "integer", "long")
    number = F.col(f"`{key}`").cast("bigint") if whole else F.when(F.col(f"`{key}`").isNotNull(), F.xxhash64(f"`{key}`"))
    start = _state("shiftrightunsigned(__key, 32)", f"(__key & {_MASK})", "0L")
    walked = (
        df.withColumn("__key", F.coalesce(number, F.lit(0).cast("bigint")))
        .withColumn("__s", F.expr(_walk(start, shards, min(shards, _STEPS))))
    )
    if shards > _STEPS:
        walked = walked.withColumn("__s", F.expr(f"if({_jump('__s')} < {shards}, {_walk('__s', shards, shards)}, __s)"))
    return (
        walked.withColumn("shard", F.expr("cast(__s.shard as int)"))
        .withColumn("grown_shard", F.expr(f"cast(if({_jump('__s')} = {shards}, {shards}, __s.shard) as int)"))
        .drop("__key", "__s")
    )


def number_slots(df: DataFrame, order: list[str]) -> DataFrame:
    """Add ``slot``: gapless from 0 within each shard, by ``order``; equal rows in any order.

    Rows are range-partitioned over all tasks, not one task per shard. Each task's share of a shard is
    contiguous, so its first number follows from the counts of the tasks before it: one small row per task and shard.
    """
    ranged = (
        df.withColumn("__tie", F.monotonically_increasing_id())
        .repartitionByRange("shard", *order, "__tie").sortWithinPartitions("shard", *order, "__tie").drop("__tie")
    )
    placed = keep(ranged.select(
        "*", F.spark_partition_id().alias("__task"),
        F.expr(f"monotonically_increasing_id() & {(1 << 33) - 1}").alias("__at"),
    ), "slots")
    shares = placed.groupBy("shard", "__task").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = F.expr("coalesce(sum(__n) over (partition by shard order by __task "
                    "rows between unbounded preceding and 1 preceding), 0)")
    return (
        placed.join(shares.withColumn("__before", before), ["shard", "__task"])
        .withColumn("slot", F.expr("__before + __at - __first"))
        .drop("__task", "__at", "__first", "__n", "__before")
    )


def size_of(text: Column, overhead: int = 16) -> Column:
    """UTF-8 bytes of the text and a fixed overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(overhead)).cast("bigint")


def write_shards(assigned: DataFrame, path: str) -> None:
    """The shards as folders ``shard=N``; AQE splits an outsized shard into several files."""
    assigned.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", size_of(F.col("text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    slots = number_slots(assign(rows, "doc_id", shards), ["doc_id", "text_crc32", "size"])
    return slots.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
