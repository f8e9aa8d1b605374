"""Personal data: fixed forms, and identifiers found by bootstrapped contexts.

Base spans are the four forms below. They seed a bootstrap over the corpus. Each identifier-like mention hangs on a
lexical patterns: the text attached to its left (as in ``tel:``), or else the word before it. Of more than ``CUE`` characters the
last ones are the pattern. Attached text and long words have shorter endings as patterns besides, from the last label with its punctuation on
(as in ``phone=`` after a URL), so a cue is found whatever stands before it. Patterns and the
values they introduce form a graph, which Spark scores in rounds: a pattern's confidence in a kind is the mean score of all
that it introduces over the whole corpus, ordinary words counting 0; a value's score is one less the product of its
patterns' doubts, where patterns with one shortest ending are one witness, the surest of them; base values keep score 1.
Values that end above ``SURE`` for a kind they have the form of are seeds from then on, support patterns of their own, and the graph is scored anew,
until no pattern is added. In one scoring of ``ROUNDS`` rounds a pattern whose other values stand nowhere else needs seeds in a third of
what it introduces. A mention that no base form matches is added if its pattern and value end above ``SURE``, and
it has the digits or the @ of that kind.

The forms are searched in time proportional to the text, whatever stands in it: a digit run or a local part is tried once, not from
each of its characters.

Defined cases: a null text is an empty one and has no spans. Spans depend on the text alone, which is keyed by its MD5, so
repeated rows and null ids are fine. Added spans never overlap base ones. An empty table gives an empty result. Only
named columns are read, so clashing ones do not matter.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.llm.common import keep, ship
from marketspark.llm.decontaminate import text_key

KINDS = ("email", "ip", "card", "phone")
CUE = 40
SUPPORT = 3  # distinct seeds that a pattern needs
SURE = 0.8
ROUNDS = 4

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NO_DIGIT = re.compile("[^0-9]+")
_NUMERIC = re.compile(r"[0-9().\x20-]{7,}+")  # a run that may hold a written number
_AT = re.compile(r"@")
_SPACE = " \t\n\x0b\f\r"
# The last label of a cue with the punctuation after it; letters beyond ASCII may be unspaced text, so two lengths of it. Python's and Java's.
_LABELS = [rf"(?:[A-Za-z0-9]+|[^\x00-\x7F]{{1,{n}}})?[\x00-/:-@\[-`{{-\x7F]*" for n in (4, 2)]
_ENDINGS = [re.compile(label + r"\Z") for label in _LABELS]

Span = tuple[int, int, int]  # place in KINDS, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        if at > free and text[at - 1] in _LOCAL_CHARS and (found := _DOMAIN.match(text, at)):
            start = at
            while start > free and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then start. A match that fails its check is dropped and not retried."""
    spans = [(0, a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return spans
    for found in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found[0].split(".")):
            spans.append((1, *found.span()))
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 16:
            digits = _NO_DIGIT.sub("", found[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, *found.span()))
    for found in _PHONE.finditer(text):
        if 8 <= len(_NO_DIGIT.sub("", found[0])) <= 15:
            spans.append((3, *found.span()))
    return spans


def _fits(kind: int, value: str) -> bool:
    """Whether a mention without a base form could be of the kind at all."""
    digits = len(_NO_DIGIT.sub("", value))
    return (
        "@" in value if kind == 0 else value.count(".") == 3 and digits >= 4 if kind == 1
        else "@" not in value and (12 <= digits <= 19 if kind == 2 else 7 <= digits <= 15)
    )


def _endings(cue: str) -> list[str]:
    """The last ``CUE`` characters, and their own endings, longest first."""
    cue = cue[-CUE:]
    return list(dict.fromkeys([cue, *(ending.search(cue)[0] for ending in _ENDINGS)]))


def _patterns(text: str, start: int) -> list[str]:
    """What stands to the left, longest first: ``=`` and endings of the attached text, or ``w`` and the word before.

    Of a word of more than ``CUE`` characters, ``v`` and its endings. None at the beginning of the text.
    """
    a = start
    while a > 0 and start - a < CUE and text[a - 1] not in _SPACE:
        a -= 1
    if a < start:
        return ["=" + e for e in _endings(text[a:start])]
    end = a
    while end > 0 and text[end - 1] in _SPACE:
        end -= 1
    a = end
    while a > 0 and end - a <= CUE and text[a - 1] not in _SPACE:
        a -= 1
    if end - a > CUE:
        return ["v" + e for e in _endings(text[a:end])]
    return ["w" + text[a:end]] if a < end else []


def mentions(text: str, spans: list[Span]) -> list[tuple[int | None, int, int, str, list[str]]]:
    """Base spans, and identifier-like mentions (kind None) clear of them: kind, start, end, value, patterns."""
    found = [(k, a, b) for k, a, b in spans]
    starts, ends = [], []  # of the base spans, overlapping ones joined
    for a, b in sorted((a, b) for _, a, b in spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    others: list[tuple[int, int]] = []
    if _DIGIT.search(text):
        for run in _NUMERIC.finditer(text):
            body = run[0].strip("). -").lstrip("(")
            if len(body) >= 7:
                a = run.start() + run[0].index(body)
                others.append((a, a + len(body)))
    for at in _AT.finditer(text):
        a, b = at.span()
        while a > 0 and at.start() - a < 64 and text[a - 1] in _LOCAL_CHARS:
            a -= 1
        while b < len(text) and b - at.end() < 253 and (text[b].isascii() and text[b].isalnum() or text[b] in ".-"):
            b += 1
        if a < at.start() and b > at.end():
            others.append((a, b))
    for a, b in others:
        at = bisect_right(ends, a)
        if (at == len(starts) or starts[at] >= b) and any(_fits(k, text[a:b]) for k in range(len(KINDS))):
            found.append((None, a, b))
    out = []
    for kind, a, b in found:
        patterns = _patterns(text, a)
        if patterns:
            out.append((kind, a, b, text[a:b], patterns))
    return out


def _show(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


_MENTION = "array<struct<kind:int,start:int,end:int,value:string,patterns:array<string>,fits:array<int>>>"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind_type = pa.list_(pa.struct([
        ("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("patterns", pa.list_(pa.string())),
        ("fits", pa.list_(pa.int32())),
    ]))
    span_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        hashes, bases, found = [], [], []
        for value in batch["text"]:
            text = value.as_py()
            spans = base_spans(text or "")
            hashes.append(hashlib.sha256(_show(spans).encode()).hexdigest())
            bases.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            found.append([
                {"kind": k, "start": a, "end": b, "value": v, "patterns": p,
                 "fits": [] if k is not None else [i for i in range(len(KINDS)) if _fits(i, v)]}
                for k, a, b, v, p in mentions(text or "", spans)
            ])
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["key"], pa.array(hashes, pa.string()), pa.array(bases, span_type), pa.array(found, kind_type)],
            ["doc_id", "key", "base_sha256", "base", "mentions"])


def searched(docs: DataFrame) -> DataFrame:
    """doc_id, key of the text, base_sha256, base spans and mentions, written; texts stay where they are."""
    ship(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        text_key(F.col("text")).alias("key"))
    schema = ("doc_id long, key binary, base_sha256 string, base array<struct<kind:int,start:int,end:int>>, "
              f"mentions {_MENTION}")
    return keep(rows.mapInArrow(_search, schema), "mentions")


def _words(word: str) -> F.Column:
    """The patterns of a column of words before others, as in :func:`_patterns`."""
    tail = F.expr(f"right({word}, {CUE})")
    endings = F.array_distinct(F.array(tail, *(F.regexp_extract(tail, label + r"\z", 0) for label in _LABELS)))
    return F.when(F.length(word) <= CUE, F.array(F.concat(F.lit("w"), word))).otherwise(
        F.transform(endings, lambda e: F.concat(F.lit("v"), e)))


def learn(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scored patterns (pattern, kind, confidence) and values (value, kind, score) after the last rounds."""
    each = found.select(F.explode("mentions").alias("m")).select("m.kind", "m.value", "m.fits", "m.patterns").select(
        "kind", "value", "fits", F.expr("element_at(patterns, -1)").alias("family"), F.explode("patterns").alias("pattern"))
    pairs = keep(each.groupBy("pattern", "family", "value").agg(
        F.count("*").alias("times"), F.max("kind").alias("own"), F.max("fits").alias("fits")), "pairs")
    # No other pattern can ever have the support.
    able = keep(pairs.groupBy("pattern").agg(F.sum("times").alias("introduced"), F.count("*").alias("n")).where(f"n >= {SUPPORT}").drop("n"), "able")
    # How often a pattern's word stands before any word of the corpus.
    words = able.where("pattern not like '=%'").select("pattern")
    before = docs.select(F.split(F.coalesce("text", F.lit("")), r"[ \t\n\x0B\f\r]+").alias("w")).select(
        F.explode(F.expr("slice(w, 1, greatest(0, size(w) - 1))")).alias("word")).where("word <> ''")
    before = before.select(F.explode(_words("word")).alias("pattern")).join(words, "pattern").groupBy("pattern").agg(F.count("*").alias("n"))
    totals = able.join(before, "pattern", "left").select("pattern", F.greatest("introduced", F.coalesce("n", F.lit(0))).alias("total"))
    known = keep(pairs.join(totals, "pattern"), "known")
    seeds = keep(pairs.where("own is not null").select("value", F.col("own").alias("kind")).distinct(), "seeds")
    count = None
    while True:
        supported = keep(
            known.join(seeds, "value").groupBy("pattern", "kind").agg(F.count("*").alias("n")).where(f"n >= {SUPPORT}").drop("n"), "patterns")
        # Seeds only become more, so as many patterns are the same ones.
        last, count = count, supported.count()
        if count == last:
            return patterns, values
        patterns, values = _scored(known, supported, seeds)
        sure = values.where(f"score >= {SURE} and array_contains(fits, kind)").select("value", "kind")
        seeds = keep(seeds.union(sure).distinct(), "seeds")


def _scored(known: DataFrame, supported: DataFrame, seeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The supported patterns and their values, scored in ``ROUNDS`` rounds from the seeds."""
    edges = keep(
        known.drop("own").join(supported, "pattern").join(seeds.withColumn("seed", F.lit(True)), ["value", "kind"], "left")
        .withColumn("seed", F.coalesce("seed", F.lit(False))), "edges")
    values = edges.groupBy("value", "kind").agg(F.max("seed").alias("seed")).select(
        "value", "kind", "seed", F.col("seed").cast("double").alias("score"))
    for _ in range(ROUNDS):
        patterns = edges.join(values.select("value", "kind", "score"), ["value", "kind"]).groupBy("pattern", "kind").agg(
            F.round(F.sum(F.expr("score * times")) / F.max("total"), 6).alias("confidence"))
        patterns = keep(patterns, "patterns")
        doubt = F.exp(F.sum(F.expr("ln(greatest(1e-9, 1 - confidence))")))
        values = keep(
            edges.join(patterns, ["pattern", "kind"]).groupBy("value", "kind", "family").agg(
                F.max("seed").alias("seed"), F.max("fits").alias("fits"), F.max("confidence").alias("confidence")).groupBy("value", "kind").agg(
                F.max("seed").alias("seed"), F.max("fits").alias("fits"), F.round(1 - doubt, 6).alias("score"))
            .withColumn("score", F.expr("if(seed, 1D, score)")), "values")
    return patterns, values


def added(docs: DataFrame, found: DataFrame) -> DataFrame:
    """key and ``extra``, the spans that sure patterns add to a text."""
    patterns, values = learn(docs, found)
    open_mentions = found.select("key", F.explode("mentions").alias("m")).select("key", "m.*").where("kind is null").drop("kind")
    open_mentions = open_mentions.withColumn("pattern", F.explode("patterns"))
    sure = open_mentions.join(patterns.where(f"confidence >= {SURE}"), "pattern").where("array_contains(fits, kind)")
    sure = sure.join(values.where(f"score >= {SURE}").select("value", "kind"), ["value", "kind"])
    # One kind per mention: the most confident, then the first listed.
    best = sure.groupBy("key", "start", "end").agg(F.min(F.struct(-F.col("confidence"), "kind")).alias("b"))
    return keep(best.groupBy("key").agg(F.collect_list(F.struct(F.col("b.kind").alias("kind"), "start", "end")).alias("extra")), "extra")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, base_sha256, and all spans as text, of every row of doc_id and text."""
    found = searched(docs)
    joined = found.drop("mentions").join(added(docs, found), "key", "left")
    empty = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    spans = F.array_sort(F.concat("base", F.coalesce("extra", empty)))
    kinds = ", ".join(f"'{k}'" for k in KINDS)
    shown = F.transform(spans, lambda s: F.concat_ws(":", F.expr(f"array({kinds})")[s["kind"]], s["start"], s["end"]))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as bigint)").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return joined.select("doc_id", *counts, "base_sha256", F.array_join(shown, ",").alias("spans"))


def redact(text: str, extra: list[Span]) -> str:
    """The text with every span replaced by its kind; spans that overlap become one, named by the first."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in [*base_spans(text), *extra]):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _redacted(kept: list[str], text_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if text is None else redact(text, [(s["kind"], s["start"], s["end"]) for s in extra or []])
                for text, extra in zip(batch[text_name].to_pylist(), batch["extra"].to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if c == text_name else batch[c] for c in kept], kept)
    return run


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with all spans of the texts replaced; n_chars, if there is one, is counted anew."""
    names = docs.columns
    extra = added(docs, searched(docs))
    columns = [f"c{i}" for i in range(len(names))]
    keyed = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), text_key(F.col("text")).alias("key"))
    text_name = f"c{names.index('text')}"
    schema = T.StructType([T.StructField(c, f.dataType) for c, f in zip(columns, docs.schema, strict=True)])
    out = keyed.join(extra, "key", "left").drop("key").mapInArrow(_redacted(columns, text_name), schema)
    final = out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
    if "n_chars" in names:
        final = final.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return final
