"""The pipeline's stages against plain versions, and its place in the entry."""

import public_tokenizers
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from marketspark.llm import bpe, pii, toxicity
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op")}
    assert names["pipeline"] is corpus_pipeline.run and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    stages = [f for _, f in corpus_pipeline.STAGES]

    kept = stages[0](spark, docs, FOLDER)
    scores = {r.doc_id: r.score for r in toxicity.toxicity(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()}
    alive = {i for i in rows if scores[i] < 0.5}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == alive

    kept = stages[1](spark, docs.where(docs.doc_id.isin(sorted(alive))), FOLDER)
    prints = {i: brute.fingerprint(rows[i].text) for i in alive}
    roots = brute.classes(brute.near(sorted(set(prints.values()))), set(prints.values()))
    least = {}
    for i in sorted(alive, reverse=True):
        least[roots[prints[i]]] = i
    alive = set(least.values())
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == alive

    kept = stages[2](spark, docs.where(docs.doc_id.isin(sorted(alive))), FOLDER)
    hit = {r[0] for r in brute.contamination([(i, rows[i].text) for i in alive], items) if r[-1]}
    alive -= hit
    assert hit and kept.columns == columns and {r.doc_id for r in kept.collect()} == alive

    kept = stages[3](spark, docs.where(docs.doc_id.isin(sorted(alive))), FOLDER)
    redacted = {r.doc_id: r for r in kept.collect()}
    assert kept.columns == columns and set(redacted) == alive
    changed = [i for i in alive if redacted[i].text != rows[i].text]
    assert changed and all(redacted[i].text == pii.redact(rows[i].text, []) and redacted[i].n_chars == len(redacted[i].text) for i in changed)

    last = stages[4](spark, kept, FOLDER)
    ranks = bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {i: library.encode_ordinary(redacted[i].text) for i in alive}
    assert {r.doc_id: r.ids for r in last.collect()} == expected
    assert {r.doc_id: r.ids for r in corpus_pipeline.run(spark, FOLDER).collect()} == expected
