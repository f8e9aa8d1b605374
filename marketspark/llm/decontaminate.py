"""Benchmark decontamination by a positional inverted index, in Spark's own expressions only.

Every run of ten words of a benchmark item is a phrase to look for. Of the terms of each phrase the rarest in the corpus drive the search. The
index stores their postings (text, term, position) over the whole corpus. A phrase's rarest list gives candidate starts
(position less the term's offset); they are intersected with the offset-adjusted lists of the next rarest terms. What remains
is compared word by word with the text around the rarest posting, which its list carries.

Terms meet in folded form (Spark's ``lower``); only the last comparison lower-cases nothing but A-Z. Texts are keyed by their MD5,
so copies share their matches, and neither nulls nor repeated ids matter.

Small vocabularies are broadcast by Spark where their written size is below its threshold, and are shuffled beyond it.

Defined cases: a null text has no words. A phrase with a term that the corpus lacks is not searched. Items of fewer than ten words are one phrase, items without words
none. Items with a null item_id hit words, but are not counted or named. Repeated items count once. Empty tables
give no matches. Only named columns are read, so clashing ones do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketspark.llm.common import keep

WORDS = 10
DRIVERS = 3

# Fixed value: everything that is no word character, before lower-casing.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _ascii_lower(column: Column | str) -> Column:
    return F.translate(column, _UPPER, _LOWER)


def _split(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """``columns``, ``parts`` (words, and empty strings at the ends where the text does not begin or end with a word), ``lead``."""
    cut = docs.select(*columns, F.split(F.coalesce("text", F.lit("")), GAP).alias("parts"))
    return cut.withColumn("lead", F.expr("if(parts[0] = '', 1, 0)"))


def _n_words() -> Column:
    return F.expr("cast(size(parts) - lead - if(size(parts) > 1 and parts[size(parts) - 1] = '', 1, 0) as bigint)")


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def phrases(items: DataFrame, words: int = WORDS) -> DataFrame:
    """item_id, phrase (words joined by a space) and its terms, for every window of the items' texts."""
    whole = _split(items.withColumn("text", _ascii_lower("text")), "item_id").withColumn("n", _n_words()).where("n > 0")
    start = F.explode(F.expr(f"sequence(0, greatest(0, cast(n as int) - {words}))")).alias("start")
    return (
        whole.select("item_id", "parts", "lead", "n", start)
        .select("item_id", F.expr(f"slice(parts, lead + start + 1, cast(least(n, {words}) as int))").alias("terms"))
        .select("item_id", F.concat_ws(" ", "terms").alias("phrase"), "terms").distinct()
    )


def frequencies(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """How often each ``term`` of the vocabulary occurs in all texts; terms that never do are left out."""
    words = _split(docs).select(F.explode("parts").alias("word")).select(F.lower("word").alias("term"))
    return words.join(vocabulary, "term").groupBy("term").agg(F.count("*").alias("n"))


def postings(docs: DataFrame, terms: DataFrame, words: int = WORDS) -> DataFrame:
    """The index: key, term, at (word position), and for ``rarest`` terms the words around, from position ``base`` on."""
    rows = _split(docs, text_key(F.col("text")).alias("key")).select("key", "parts", "lead", F.posexplode("parts").alias("raw", "word"))
    met = rows.where("word <> ''").withColumn("term", F.lower("word")).join(terms, "term")
    first = f"greatest(raw - {words - 1}, lead)"
    return met.select(
        "key", "term", F.expr("raw - lead").alias("at"), F.expr(f"{first} - lead").alias("base"),
        F.expr(f"if(rarest, slice(parts, {first} + 1, raw - {first} + {words}), null)").alias("around"),
    )


def matches(docs: DataFrame, items: DataFrame, words: int = WORDS, drivers: int = DRIVERS) -> tuple[DataFrame, DataFrame]:
    """Exact occurrences (key, start, length, phrase) of the items' phrases, and the phrases with their item_id."""
    found = keep(phrases(items, words), "phrases")
    terms = found.select("phrase", "terms").distinct().select(
        "phrase", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "word")
    ).select("phrase", "length", "offset", F.lower("word").alias("term"))
    counted = keep(frequencies(docs, keep(terms.select("term").distinct(), "vocabulary")), "frequencies")
    rare = Window.partitionBy("phrase").orderBy("n", "offset")
    ranked = terms.join(counted, "term", "left").withColumn("n", F.coalesce("n", F.lit(0))).select(
        "*", F.row_number().over(rare).alias("rank"), F.min("n").over(Window.partitionBy("phrase")).alias("least"))
    driving = keep(ranked.where(f"least > 0 and rank <= {drivers}").drop("least", "n"), "drivers")
    wanted = keep(driving.groupBy("term").agg(F.max(F.expr("rank = 1")).alias("rarest")), "terms")
    index = keep(postings(docs, wanted, words), "postings")

    rarest = driving.where("rank = 1").drop("rank")
    starts = index.where("around is not null").join(rarest, "term").select(
        "phrase", "length", "key", F.expr("at - offset").alias("start"),
        F.expr("if(at - offset >= base, concat_ws(' ', slice(around, at - offset - base + 1, length)), '')").alias("seen"),
    ).distinct()
    others = driving.where("rank > 1").select("phrase", "term", "offset")
    needed = starts.select("phrase", "key", "start").join(others, "phrase").select(
        "phrase", "key", "start", "term", F.expr("start + offset").alias("at"))
    agreed = needed.join(index.select("key", "term", "at"), ["key", "term", "at"], "left_semi").groupBy(
        "phrase", "key", "start").agg(F.count("*").alias("n"))
    both = starts.join(agreed, ["phrase", "key", "start"], "left").where(
        f"start >= 0 and coalesce(n, 0) = least(length, {drivers}) - 1")
    exact = both.where(_ascii_lower("seen") == F.col("phrase")).select("key", "start", "length", "phrase")
    return keep(exact, "matches"), found


def near_matches(docs: DataFrame, items: DataFrame, slop: int, words: int = WORDS, drivers: int = DRIVERS) -> DataFrame:
    """Proximity matches: key, phrase and ``at`` of every posting of the phrase's rarest term that has
    each other term of the phrase within ``slop`` words, in any order. The ``drivers`` rarest terms find the candidates; a phrase with a
    term that no text has is no match, and a term that a phrase repeats need occur once."""
    terms = phrases(items, words).select("phrase", F.posexplode("terms").alias("offset", "word")).select(
        "phrase", "offset", F.lower("word").alias("term")).distinct()
    counted = frequencies(docs, keep(terms.select("term").distinct(), "vocabulary"))
    rare = Window.partitionBy("phrase").orderBy("n", "offset")
    one = terms.groupBy("phrase", "term").agg(F.min("offset").alias("offset")).join(counted, "term", "left").withColumn(
        "n", F.coalesce("n", F.lit(0)))
    ranked = one.select("*", F.row_number().over(rare).alias("rank"), F.min("n").over(Window.partitionBy("phrase")).alias("least"))
    ranked = keep(ranked.where("least > 0").drop("least"), "ranked")
    driving = ranked.where(f"rank <= {drivers}")
    wanted = driving.groupBy("term").agg(F.lit(False).alias("rarest"))
    index = keep(postings(docs, keep(wanted, "terms"), words).select("key", "term", "at").distinct(), "postings")
    starts = index.join(driving.where("rank = 1").select("phrase", "term"), "term").select("phrase", "key", "at")
    candidates = keep(_surrounded(starts, driving.where("rank > 1"), index, slop), "candidates")
    rest = ranked.where(f"rank > {drivers}")
    texts = docs.withColumn("key", text_key(F.col("text"))).join(candidates.select("key").distinct(), "key", "left_semi").select("text")
    others = rest.select("term").distinct().withColumn("rarest", F.lit(False))
    return _surrounded(candidates, rest, postings(texts, others, words).select("key", "term", "at").distinct(), slop)


def _surrounded(starts: DataFrame, terms: DataFrame, index: DataFrame, slop: int) -> DataFrame:
    """The starts (key, phrase, at) that have each of their phrase's terms within ``slop`` words."""
    needed = starts.join(terms.select("phrase", "term"), "phrase")
    close = needed.join(index.withColumnRenamed("at", "other"), ["key", "term"]).where(f"abs(other - at) <= {slop}")
    agreed = close.groupBy("phrase", "key", "at").agg(F.countDistinct("term").alias("n"))
    count = terms.groupBy("phrase").agg(F.count("*").alias("wanted"))
    return (
        starts.join(count, "phrase", "left").join(agreed, ["phrase", "key", "at"], "left")
        .where("coalesce(n, 0) = coalesce(wanted, 0)").select("key", "phrase", "at")
    )


def hits(docs: DataFrame, items: DataFrame, words: int = WORDS) -> DataFrame:
    """key, n_hit (words inside any match) and the matched item_ids, of every text with a match."""
    exact, found = matches(docs, items, words)
    by_start = Window.partitionBy("key").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    covered = exact.select("key", "start", "length").distinct().withColumn(
        "before", F.coalesce(F.max(F.expr("start + length")).over(by_start), F.lit(0))
    ).groupBy("key").agg(F.sum(F.expr("greatest(0, start + length - greatest(start, before))")).alias("n_hit"))
    named = exact.select("key", "phrase").distinct().join(found.select("phrase", "item_id"), "phrase").groupBy("key").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    return covered.join(named, "key")


def contamination(docs: DataFrame, items: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of doc_id and text."""
    rows = _split(docs, "doc_id", text_key(F.col("text")).alias("key")).select("doc_id", "key", _n_words().alias("n_words"))
    joined = rows.join(hits(docs, items, words), "key", "left")
    named = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(named).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", named), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no phrase of the items."""
    names = docs.columns
    keyed = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), text_key(F.col("text")).alias("key"))
    found = hits(docs.select("text"), items, words).select("key")
    return keyed.join(found, "key", "left_anti").select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
