"""Bronze and staging kept up to date from new files only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketspark.operators.landing import enrich
from marketspark.operators.quality import Rule, with_reasons
from marketspark.operators.quarantine import letters, quarantine
from marketspark.operators.upsert import upsert
from marketspark.session import drop_stored, stored
from marketspark.sources.bronze import stream_documents, write_landed_step


def stage_new_files(
    spark: SparkSession, root: str, schema: T.StructType, stage: Callable[[DataFrame], DataFrame],
    target: str, keys: Sequence[str], order: Sequence[str], checkpoint: str,
    multi_line: bool = True, files_per_batch: int = 10_000, pattern: str = "*.json",
    rules: Callable[[DataFrame], Sequence[Rule]] | None = None, feed: str = "", dead: str | None = None,
    changed: Callable[[str], None] | None = None,
) -> StreamingQuery:
    """Read the files that came since the last run, upsert their valid rows, and stop.

    ``checkpoint`` remembers the files read. A batch that is repeated after a failure
    replaces the same keys with the same rows, so nothing is applied twice. The last
    row of a key by ``order`` wins over all files, so ``files_per_batch`` only sets the
    size of the steps. With ``rules`` the rows that fail go to the quarantine table at
    ``dead`` as letters of ``feed``; a step's documents are then parsed once and stored.
    ``changed`` is told the first day of a step's valid rows before they are applied.
    """
    def apply(batch: DataFrame, _: int) -> None:
        rows = batch
        if rules:
            rows = stored(with_reasons(batch, rules(batch)), "screened")
            quarantine(letters(rows, feed), dead)
        valid = stage(rows.where("first_reason is null") if rules else rows)
        first = valid.agg(F.min("date")).first()[0] if changed else None
        if first:
            changed(first.isoformat())
        upsert(valid, target, keys, order, keep_latest=True)
        if rules:
            drop_stored(rows)

    return (
        stream_documents(spark, root, schema, multi_line, files_per_batch, pattern).writeStream
        .foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def land_new_files(
    spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], arrival: Sequence[str],
    target: str, checkpoint: str, source: str, run_at: str | None = None, multi_line: bool = True,
    files_per_batch: int = 10_000, pattern: str = "*.json", grain: str = "day",
) -> StreamingQuery:
    """Land the first record of every key out of the files that came since the last run, and stop.

    The state store remembers, per key, the first record: that of the earliest step, and in it
    the first by ``arrival``, then by file and content. A step emits the keys that it saw first and
    no others, so a later file never replaces what has landed, whatever its arrival says;
    a step is what came since the last run, up to ``files_per_batch`` files. Records without a full key land once
    per content. A step that is repeated after a failure rewrites its own folder. The state
    holds one record per key ever landed.
    """
    documents = stream_documents(spark, root, schema, multi_line, files_per_batch, pattern)
    full = " and ".join(f"`{key}` is not null" for key in keys)
    content = ", ".join(f"`{name}`" for name in schema.fieldNames())
    key = f"if({full}, to_json(struct({', '.join(f'`{key}`' for key in keys)})), to_json(struct('' as content, {content})))"
    order = ", ".join(f"`{name}` as `_{name}`" for name in (*arrival, "source_file"))
    # The time of a step is fixed when the step begins and grows from one to the next.
    timed = documents.selectExpr("*", f"{key} as _key", "current_timestamp() as _step")
    firsts = timed.groupBy("_key").agg(F.expr(f"min(struct(_step, {order}, {content})) as first"))
    fresh = firsts.where("first._step = current_timestamp()").select(*[f"first.{name}" for name in schema.fieldNames()])

    def apply(batch: DataFrame, step: int) -> None:
        write_landed_step(enrich(batch, source, run_at), target, step, grain)

    return (
        fresh.writeStream.outputMode("update")
        .foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
