"""Toxic spans by a linear-chain conditional random field.

The field has two states, harmless and toxic, over the words of a sentence. A common word's feature is itself; a rare or unseen
one's are its first letters, so unseen forms of a stem count. It is fitted on a bounded sample of labelled documents: up to ``SAMPLE`` of each label, the least by a hash of doc_id,
of at most ``SAMPLE_CHARS`` characters each, without near copies of one another. Document labels become word labels there by a test of association (G squared): in toxic
documents the words with an associated stem are toxic, all else is harmless.

Scoring covers every word of every text. Forward and backward passes give each word's marginal; the document's score is a logistic
function of the largest marginal and of the expected number of toxic words, fitted on the sample and weighted to the labels' true shares.

Defined cases: a null or empty text has no words and the score of a document without toxic words. Without labels of both kinds there is nothing to
learn, and the score is the share of toxic labels (0 without labels). A doc_id with several labels is toxic if any of them is; null labels do not count.
Sentences are as long as they are; the passes run over them whole. Repeated rows are scored alike. Empty tables give empty results. Only
named columns are read, so clashing ones do not matter.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Container, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.llm.common import ship

SAMPLE = 1200
SAMPLE_CHARS = 20_000
_RATIO, _SHARE = 10.0, 0.02  # of toxic against other documents; of the toxic documents that have a telling feature
_ROUNDS, _RATE, _DECAY = 40, 0.3, 1e-4
_COMMON = 5  # documents of the sample
_FLOOR = 0.1  # smaller marginals are all alike to a document's score
_STORE = 300_000
_BATCH = 100_000  # words scored together, about
_CELLS = 250_000  # words and fillings of one array

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def features(word: str, common: Container[str]) -> tuple[str, str]:
    """Two features: a common word and nothing, or the first letters of another."""
    return (word, "") if word in common else (word[:4] + "*", word[:5] + "**")


def sentences(text: str) -> list[list[tuple[str, int, int]]]:
    """Lower-case words with their places, by sentence; sentences without words are left out."""
    out = []
    for found in _SENTENCE.finditer(text):
        words = [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text, found.start(), found.end())]
        if words:
            out.append(words)
    return out


@dataclass
class Field:
    """Feature weights of the toxic state (of every common word), the log odds without features, and the transition scores."""

    weights: dict[str, float]
    bias: float
    moves: np.ndarray  # [from, to]
    calibration: tuple[float, float, float]  # of the logistic function
    constant: float | None = None  # the score, if nothing could be learned

    def emission(self, word: str) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in features(word, self.weights))


def passes(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, pairs: bool = False):
    """Marginal of the toxic state for every word, from the concatenated sentences' scores; with ``pairs`` the expected moves too.

    Sentences of like length run side by side; each step is one array operation over them.
    """
    lengths = np.asarray(lengths)
    starts = np.cumsum(lengths) - lengths
    marginals = np.empty(len(scores))
    expected = np.zeros((2, 2))
    step = np.exp(moves)
    odds = np.exp(np.clip(scores, -30, 30))
    order = np.argsort(lengths, kind="stable")
    classes = np.ceil(np.log2(np.maximum(lengths[order], 1))).astype(int)
    for size in np.unique(classes):
        group = order[classes == size]
        longest = int(lengths[group].max())
        rows = max(1, _CELLS // longest)
        for k in range(0, len(group), rows):
            some = group[k:k + rows]
            inside = np.arange(longest) < lengths[some][:, None]
            at = np.where(inside, starts[some][:, None] + np.arange(longest), 0)
            e = np.where(inside, odds[at], 1.0).T.copy()  # [time, sentence]
            live = inside.T
            forward = np.empty((longest, 2, len(some)))
            a0, a1 = 1 / (1 + e[0]), e[0] / (1 + e[0])
            forward[0] = a0, a1
            for t in range(1, longest):
                n0 = a0 * step[0, 0] + a1 * step[1, 0]
                n1 = (a0 * step[0, 1] + a1 * step[1, 1]) * e[t]
                total = n0 + n1
                a0, a1 = n0 / total, n1 / total
                forward[t] = a0, a1
            b0 = b1 = np.ones(len(some))
            toxic = np.empty((longest, len(some)))
            for t in range(longest - 1, -1, -1):
                if t < longest - 1:
                    on = live[t + 1]
                    m1 = e[t + 1] * b1
                    n0 = np.where(on, step[0, 0] * b0 + step[0, 1] * m1, 1.0)
                    n1 = np.where(on, step[1, 0] * b0 + step[1, 1] * m1, 1.0)
                    if pairs:
                        f0, f1 = forward[t]
                        p = np.array([[f0 * step[0, 0] * b0, f0 * step[0, 1] * m1], [f1 * step[1, 0] * b0, f1 * step[1, 1] * m1]])
                        expected += (p / p.sum((0, 1)) * on).sum(2)
                    total = n0 + n1
                    b0, b1 = n0 / total, n1 / total
                p1 = forward[t, 1] * b1
                toxic[t] = p1 / (p1 + forward[t, 0] * b0)
            marginals[at[inside]] = toxic.T[inside]
    return (marginals, expected) if pairs else marginals


def document_inputs(marginals: np.ndarray, owners: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of each document's largest marginal, and log(1 + expected toxic words), over its words' ``owners``."""
    largest, count = np.full(documents, _FLOOR), np.zeros(documents)
    np.maximum.at(largest, owners, marginals)
    np.add.at(count, owners, np.where(marginals >= 0.5, marginals, 0.0))
    largest = np.clip(largest, _FLOOR, 1 - 1e-6)
    return np.log(largest / (1 - largest)), np.log1p(count)


def _distinct(texts: list[str]) -> list[int]:
    """Places of texts that share under half of their eight least shingle hashes with those before: copies would make chance words look telling."""
    seen: set[int] = set()
    kept = []
    for i, text in enumerate(texts):
        words = _WORD.findall(text.lower())
        shingles = {" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))}
        least = sorted(xxhash.xxh64_intdigest(s) for s in shingles)[:8]
        if 2 * len(seen.intersection(least)) < len(least):
            kept.append(i)
        seen.update(least)
    return kept


def _associated(words: Iterable[set[str]], labels: list[int], common: set[str]) -> set[str]:
    """Features that are found in toxic documents beyond chance and far more often than in others."""
    seen = (Counter(), Counter())
    for some, label in zip(words, labels, strict=True):
        seen[label].update({f for w in some for f in features(w, common) if f})
    sizes = labels.count(0), labels.count(1)
    out, bar = set(), 2 * math.log(len(seen[1]) + 2)  # so strict that few of the features seen pass by chance
    for feature, a in seen[1].items():
        b = seen[0][feature]
        share = (a + b) / sum(sizes)
        ratio = ((a + 0.5) / (sizes[1] + 1)) / ((b + 0.5) / (sizes[0] + 1))
        g2 = sum(2 * o * math.log(o / x) for o, x in (
            (a, sizes[1] * share), (b, sizes[0] * share), (sizes[1] - a, sizes[1] * (1 - share)), (sizes[0] - b, sizes[0] * (1 - share)),
        ) if o > 0 and x > 0)
        if g2 >= bar and ratio >= _RATIO and a >= _SHARE * sizes[1]:
            out.add(feature)
    return out


def fit(texts: list[str], labels: list[int], shares: tuple[float, float]) -> Field:
    """A field from documents and their labels; ``shares`` are the labels' shares among all labelled documents."""
    if len(set(labels)) < 2:
        return Field({}, 0.0, np.zeros((2, 2)), (0.0, 0.0, 0.0), constant=shares[1])
    some = _distinct(texts)
    texts, labels = [texts[i] for i in some], [labels[i] for i in some]
    def words_of(text: str) -> set[str]:
        return {w for s in sentences(text) for w, _, _ in s}

    common = {w for w, n in Counter(w for text in texts for w in words_of(text)).items() if n >= _COMMON}
    telling = _associated(map(words_of, texts), labels, common)
    names: dict[str, int] = {"": 0}
    columns, lengths, owners, truth = array("i"), array("i"), array("i"), array("b")
    for d, (text, label) in enumerate(zip(texts, labels, strict=True)):
        for words in sentences(text):
            lengths.append(len(words))
            for word, _, _ in words:
                own = features(word, common)
                columns.extend(names.setdefault(f, len(names)) for f in own)
                truth.append(int(label and any(f in telling for f in own)))
                owners.append(d)
    index = np.frombuffer(columns, dtype=np.int32).reshape(-1, 2)
    lengths = np.array(lengths)
    y = np.array(truth, dtype=float)
    first = np.cumsum(lengths) - lengths
    follow = np.ones(len(y), dtype=bool)
    follow[first] = False
    to = np.flatnonzero(follow)
    seen_moves = np.zeros((2, 2))
    np.add.at(seen_moves, (y[to - 1].astype(int), y[to].astype(int)), 1)
    weights, bias, moves = np.zeros(len(names)), math.log((y.sum() + 1) / (len(y) - y.sum() + 1)), np.zeros((2, 2))
    squares, bias_squares, move_squares = np.zeros(len(names)), 0.0, np.zeros((2, 2))
    for _ in range(_ROUNDS):  # AdaGrad on the log likelihood
        marginals, expected = passes(bias + weights[index[:, 0]] + weights[index[:, 1]], lengths, moves, pairs=True)
        rest = y - marginals
        grown = sum(np.bincount(index[:, k], rest, len(names)) for k in range(2)) - _DECAY * len(y) / len(names) * weights
        grown[0] = 0.0  # the missing second feature of common words
        squares += grown**2
        weights += _RATE * grown / np.sqrt(squares + 1e-8)
        bias_squares += rest.sum() ** 2
        bias += _RATE * rest.sum() / math.sqrt(bias_squares + 1e-8)
        moved = seen_moves - expected
        move_squares += moved**2
        moves += _RATE * moved / np.sqrt(move_squares + 1e-8)
    marginals = passes(bias + weights[index[:, 0]] + weights[index[:, 1]], lengths, moves)
    inputs = document_inputs(marginals, np.array(owners), len(texts))
    kept = {f: float(weights[i]) for f, i in names.items() if f in common or f and abs(weights[i]) > 0.05}
    return Field(kept, float(bias), moves, _calibrate(*inputs, np.array(labels, dtype=float), shares))


def _calibrate(peak: np.ndarray, count: np.ndarray, y: np.ndarray, shares: tuple[float, float]) -> tuple[float, float, float]:
    """Weighted logistic regression by Newton's method, slightly ridged."""
    x = np.stack([np.ones_like(peak), peak, count], 1)
    w = np.where(y == 1, shares[1] / max(y.sum(), 1), shares[0] / max((1 - y).sum(), 1)) * len(y)
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        ridge = np.diag([1e-3, 1.0, 1.0])
        beta += np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (w * (y - p)) - ridge @ beta)
        beta = np.clip(beta, -50, 50)
    return tuple(float(b) for b in beta)


def score_texts(field: Field, texts: list[str | None], emissions: dict[str, float]) -> list[tuple[float, str]]:
    """Score and offending spans (start:end, in code points, comma-joined) of each text."""
    places, lengths, owners = [], [], []
    for d, text in enumerate(texts):
        for words in sentences(text or ""):
            lengths.append(len(words))
            places += words
            owners += [d] * len(words)
    values = []
    for word, _, _ in places:
        value = emissions.get(word)
        if value is None:
            if len(emissions) > _STORE:
                emissions.clear()
            value = emissions[word] = field.emission(word)
        values.append(value)
    marginals = passes(np.array(values), np.array(lengths, dtype=int), field.moves)
    owned = np.array(owners, dtype=int)
    peak, count = document_inputs(marginals, owned, len(texts))
    a, b, c = field.calibration
    scores = 1 / (1 + np.exp(-np.clip(a + b * peak + c * count, -30, 30)))
    spans: list[list[str]] = [[] for _ in texts]
    for i in np.flatnonzero(marginals >= 0.5).tolist():
        spans[owners[i]].append(f"{places[i][1]}:{places[i][2]}")
    if field.constant is not None:
        scores = np.full(len(texts), field.constant)
    return list(zip(scores.tolist(), map(",".join, spans), strict=True))


def _scored(shared, text_name: str, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, emissions = shared.value, {}
        for batch in batches:
            out, group, size = [], [], 0
            for value in batch[text_name]:
                text = value.as_py()
                group.append(text)
                size += len(text or "")
                if size >= 2 * _BATCH:
                    out += score_texts(field, group, emissions)
                    group, size = [], 0
            out += score_texts(field, group, emissions) if group else []
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array([s for s, _ in out], pa.float64()), pa.array([x for _, x in out], pa.string())],
                [*kept, "score", "offending"])
    return run


def remainder(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Field:
    """Fit on labelled documents, but for those whose crc32(doc_id as text) mod 5 is 0. Both tables' other columns are not read."""
    known = (
        labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .where(remainder(F.col("doc_id")) != 0)
    )
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    shares = (counts.get(0, 0) / total, counts.get(1, 0) / total) if total else (0.0, 0.0)
    drawn = known.where("toxic = 0").orderBy(F.xxhash64("doc_id")).limit(sample).unionByName(
        known.where("toxic = 1").orderBy(F.xxhash64("doc_id")).limit(sample))
    # At most 2 * sample ids, and so many bounded texts, reach the driver.
    ids = docs.sparkSession.createDataFrame(drawn.collect(), drawn.schema)
    rows = docs.where(F.length("text") <= sample_chars).select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic")).orderBy("doc_id").collect()
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows], shares)


def scored(docs: DataFrame, field: Field, *columns: str) -> DataFrame:
    """``columns`` of ``docs``, score and offending spans of the column text."""
    spark = docs.sparkSession
    ship(spark)
    kept = [c for c in columns if c not in ("score", "offending")]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("score", T.DoubleType()), T.StructField("offending", T.StringType())])
    # The field's size is bounded by the sample it was fitted on.
    return docs.select(*dict.fromkeys([*kept, "text"])).mapInArrow(_scored(spark.sparkContext.broadcast(field), "text", kept), schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, offending spans of every row of doc_id and text."""
    return scored(docs, train(docs, labels), "doc_id").select(
        "doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "offending")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted toxic."""
    names = docs.columns
    marked = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), F.col("text"))
    out = scored(marked, train(docs, labels), *(f"c{i}" for i in range(len(names))))
    return out.where("score < 0.5").select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
