"""What each of five filters removes, alone and in all orders, kept by a stream that takes back earlier verdicts.

The documents are a stream of files, read in micro-batches until none is left. A document's verdict is a mask of the filters it
fails. Filters A to D see the text alone; E fails a text that a row of smaller doc_id has as well, and that is known for certain only when all
files are in. Every text is therefore known by its SHA-256 in a state: the least doc_id so far, its mask, and how many rows of each part have it. A row with a
larger id fails E for good. A row with a smaller id takes the place; the rows it displaces are retracted from their counter (-1) and
counted again with E (+1). The changes are an append-only table; its sums are the counters, whatever the order of files or the size of steps.

A call into Python for every text would cost milliseconds each, so texts are dealt by their digest to a few buckets per shuffle partition, and a bucket's state holds its texts. More
partitions make smaller states.

Rows that meet a smaller id of their text within one Arrow batch fail E for certain; they are dealt to all buckets alike, so a text that a third of all rows share
sends its bucket one row a batch.

Counters hold one row per part and mask (32 at most), so all orders are arithmetic on them: a filter removes the masks that have its bit and none before it.

The state store is the session's; where states outgrow the executors' memory, choose RocksDB in ``spark.sql.streaming.stateStore.providerClass``.

Defined cases: a null text is an empty one: it has no words, so it fails A alone, and E behind an equal one. A null lang and an empty one are the part ''.
A row of null doc_id is neither smaller nor larger than others: it never fails E, and has no labels. Repeated rows count each; rows of one text and one
doc_id do not make each other fail E. Several labels of one doc_id count as 1 if any is. Very long texts are one row each. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import io
import json
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
import pyarrow.ipc  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marketspark.llm.common import ship
from marketspark.session import scratch

FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")
STEPS = 8  # micro-batches that the files are dealt to
BUCKETS = 2  # states per shuffle partition
_UPPER = bytes(range(65, 91))
_MARKS = b"#$%&*|"
_ROWS = "bucket int, digest binary, named boolean, doc_id long, part string, mask int, n long"
_STATE = "texts binary"
_CHANGES = "named boolean, doc_id long, part string, mask int, delta long"
_KNOWN = pa.schema([("digest", pa.binary(32)), ("doc_id", pa.int64()), ("mask", pa.int32()), ("part", pa.string()), ("n", pa.int64())])


def text_mask(text: bytes, points: int) -> int:
    """Bits of the filters A to D that a text of so many code points fails."""
    words = text.split()  # of bytes: the six ASCII white spaces
    capitals = len(text) - len(text.translate(None, _UPPER))
    fails = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * capitals > 3 * points,
        len(text.translate(None, _MARKS)) < len(text),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def _marked(buckets: int):
    """One row per text, id and part of a batch: least ids with their digest, all others, whose verdict stands, without."""
    layout = pa.schema([
        ("bucket", pa.int32()), ("digest", pa.binary()), ("named", pa.bool_()), ("doc_id", pa.int64()), ("part", pa.string()),
        ("mask", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, least = Counter(), {}
            for doc_id, text, part in zip(batch["doc_id"].to_pylist(), batch["text"], batch["part"].to_pylist(), strict=True):
                text = text.as_py() or ""
                raw = text.encode()
                digest = hashlib.sha256(raw).digest()
                rows[digest, doc_id, part, text_mask(raw, len(text))] += 1
                if doc_id is not None and doc_id <= least.get(digest, doc_id):
                    least[digest] = doc_id
            out = []
            for i, ((digest, doc_id, part, mask), n) in enumerate(rows.items()):
                if doc_id is None:
                    out.append((i % buckets, None, False, 0, part, mask, n))
                elif doc_id > least[digest]:
                    out.append((i % buckets, None, True, doc_id, part, mask | REPEATED, n))
                else:
                    out.append((int.from_bytes(digest[:8]) % buckets, digest, True, doc_id, part, mask, n))
            columns = zip(*out, strict=True) if out else [[]] * len(layout)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, layout.types, strict=True)], schema=layout)
    return run


Known = dict[bytes, tuple[int, int, Counter]]  # by digest: least doc_id, mask, rows of each part


def freeze(texts: Known) -> bytes:
    rows = [(digest, doc_id, mask, part, n) for digest, (doc_id, mask, parts) in texts.items() for part, n in parts.items()]
    table = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KNOWN.types, strict=True)], schema=_KNOWN)
    out = io.BytesIO()
    with pa.ipc.new_stream(out, _KNOWN) as stream:
        stream.write(table)
    return out.getvalue()


def thaw(frozen: bytes) -> Known:
    texts: Known = {}
    for digest, doc_id, mask, part, n in zip(*(c.to_pylist() for c in pa.ipc.open_stream(frozen).read_all().columns), strict=True):
        texts.setdefault(digest, (doc_id, mask, Counter()))[2][part] += n
    return texts


def verdicts(rows: Iterator[tuple], texts: Known) -> list[tuple]:
    """Changes of the counters by rows (digest, doc_id, part, mask, n); ``texts`` is updated."""
    out = []
    for digest, doc_id, part, mask, n in rows:
        least, _, parts = texts.get(digest, (None, mask, Counter()))
        if least is not None and doc_id > least:
            out.append((True, doc_id, part, mask | REPEATED, n))
            continue
        if least != doc_id:
            for displaced, k in parts.items():
                out += [(True, least, displaced, mask, -k), (True, least, displaced, mask | REPEATED, k)]
            parts = Counter()
            texts[digest] = doc_id, mask, parts
        parts[part] += n
        out.append((True, doc_id, part, mask, n))
    return out


def _changes(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes of the counters by the rows of one bucket; its state is updated."""
    names = ["named", "doc_id", "part", "mask", "delta"]
    texts = thaw(state.get[0]) if state.exists else {}
    for frame in frames:
        stands = frame["digest"].isna()
        yield frame[stands].rename(columns={"n": "delta"})[names]
        rest = frame[~stands]
        columns = (rest[c].tolist() for c in ("digest", "doc_id", "part", "mask", "n"))
        yield pd.DataFrame(verdicts(zip(*columns, strict=True), texts), columns=names)
    if texts:
        state.update((freeze(texts),))


def _pattern(path: str) -> str:
    """A pattern that only this path matches: a stream reads a pattern's files, but as a plain path takes folders only."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def changes(spark: SparkSession, path: str, steps: int = STEPS) -> DataFrame:
    """named, doc_id, part, mask, delta: all additions and retractions after the files of a Parquet table (doc_id, text, lang) ran through.

    The table is in the shared folder, and so are the offsets and states of the run.
    """
    ship(spark)
    table = spark.read.parquet(path)
    files = max(1, -(-len(table.inputFiles()) // steps))
    target, offsets = scratch(spark, "changes"), scratch(spark, "offsets")
    folder = spark._jvm.org.apache.hadoop.fs.Path(target)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(_pattern(path))
    rows = source.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    found = rows.mapInArrow(_marked(buckets), _ROWS).groupBy("bucket").applyInPandasWithState(
        _changes, _CHANGES, _STATE, "append", GroupStateTimeout.NoTimeout)
    found.writeStream.format("parquet").option("path", target).option("checkpointLocation", offsets).trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.schema(_CHANGES).parquet(target)


def counters(changed: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: rows of each verdict, and those labelled so."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.expr("quality = 1")).alias("is_good"), F.max(F.expr("toxic = 1")).alias("is_toxic"))
    verdicts = changed.groupBy(F.expr("if(named, doc_id, null)").alias("doc_id"), "part", "mask").agg(F.sum("delta").alias("n")).where("n <> 0")
    return verdicts.join(known.hint("merge"), "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.expr("if(is_good, n, 0)")).alias("good"), F.sum(F.expr("if(is_toxic, n, 0)")).alias("toxic"))


def orders() -> list[dict[str, object]]:
    """filter_order, step, the bits before it and its own, of every permutation."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << FILTERS.index(letter)
            out.append({"filter_order": "".join(order), "step": step, "before": before, "own": own})
            before |= own
    return out


def interactions(counted: DataFrame) -> DataFrame:
    """One row per part, order and step, from the counters."""
    layout = "array<struct<filter_order: string, step: int, before: int, own: int>>"
    steps = F.explode(F.from_json(F.lit(json.dumps(orders())), layout)).alias("s")
    each = counted.select("*", steps).select("part", "mask", "n", "good", "toxic", "s.*")
    fails, earlier = "(mask & own) <> 0", "(mask & before) <> 0"
    sums = {
        "kept": f"if({earlier} or {fails}, 0, n)",
        "removed": f"if({fails} and not {earlier}, n, 0)",
        "redundant": f"if({fails} and {earlier}, n, 0)",
        "unique_fails": "if(mask = own, n, 0)",
        "good_lost": f"if({fails} and not {earlier}, good, 0)",
        "toxic_lost": f"if({fails} and not {earlier}, toxic, 0)",
        # Of a mask's filters each comes first in the same share of the 120 orders.
        "shapley": f"if({fails}, n * (120 div bit_count(mask)), 0)",
    }
    return each.groupBy("part", "filter_order", "step").agg(*(F.expr(f"sum({value})").cast("long").alias(name) for name, value in sums.items()))


def audit(spark: SparkSession, path: str, labels: DataFrame, steps: int = STEPS) -> DataFrame:
    """part, filter_order, step and the counts of that step, over a Parquet table at ``path``."""
    return interactions(counters(changes(spark, path, steps), labels))
