"""WARC, toxicity, nearest neighbours, language-model scores, repeated strings."""

import base64
import hashlib
import itertools
import math
import random
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from marketspark.llm import ann, ctw, pfp, toxicity, warc
from marketspark.llm.common import keep
from tests.llm import brute
from tests.llm.test_text_operators import AWKWARD, table


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "s") for i, u, h in rows], "page_id long, url string, html string, sha256 string")


PAGES = [
    (1, "http://a", "<p>é</p>"), (2, "http://b\r\nX: y", "<p>é</p>"), (3, None, None), (4, "u", ""), (5, "u", "own"), (5, "u2", "own"), (None, "n", "lost"),
    (7, "u", "x" * 200_000), (8, "u", "lost"), (None, "m", "lone"),
]


def test_archive(spark, tmp_path):
    got = warc.archive_pages(spark, pages(spark, PAGES)).collect()
    last = {}
    for i, _, h in PAGES:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest)) for r in got) == sorted(str((i, len((h or "").encode()), digest(h))) for i, _, h in PAGES)
    for html in last:
        mine = [r for r in got if r.payload_digest == digest(html)]
        responses = [r for r in mine if r.record_type == "response"]
        assert len(responses) == 1 and responses[0].refers_to is None and (-1 if responses[0].page_id is None else responses[0].page_id) == last[html]
        assert all(r.refers_to == responses[0].page_id for r in mine if r.record_type == "revisit")
    path = str(tmp_path / "archive")
    warc.write_archive(pages(spark, PAGES), path, min_bytes=4)
    records = warc.read_archive(spark, path).collect()
    assert all(r.intact for r in records) and {r.record_type for r in records if r.payload_bytes < 4} == {"response"}
    assert spark.read.parquet(f"{path}/payloads").count() == len(last)
    for r in records:
        block, _, body = bytes(r.record).partition(b"\r\n\r\n")
        assert body.endswith(b"\r\n\r\n") and hashlib.sha1(body[:-4]).digest() == base64.b32decode(r.payload_digest)
        assert block.startswith(b"WARC/1.1\r\nWARC-Type: ") and block.count(b"X: y") == block.count(b"%0D%0AX: y")
    assert warc.archive_pages(spark, pages(spark, [])).count() == 0


def test_passes_equal_enumeration():
    draw = np.random.default_rng(1)
    lengths = np.array([1, 4, 2, 7, 3, 4])
    scores, moves = draw.normal(size=lengths.sum()) * 2, draw.normal(size=(2, 2))
    got, expected = toxicity.passes(scores, lengths, moves, pairs=True)
    start, pairs, marginals = 0, np.zeros((2, 2)), []
    for n in lengths:
        own, total, m, p = scores[start:start + n], 0.0, np.zeros(n), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=int(n)):
            w = math.exp(sum(s * x for s, x in zip(own, states, strict=True)) + sum(moves[a, b] for a, b in itertools.pairwise(states)))
            total += w
            m += w * np.array(states)
            for a, b in itertools.pairwise(states):
                p[a, b] += w
        marginals += list(m / total)
        pairs += p / total
        start += n
    assert np.allclose(got, marginals) and np.allclose(expected, pairs)


def test_toxicity(spark):
    draw = random.Random(2)
    words = [f"{a}{b}" for a in ("lan", "ter", "mos", "vik", "pra") for b in ("go", "den", "ira", "ule", "ost")]
    bad = ["nastya", "nastyb", "vilerog"]
    rows, labels = [], []
    for i in range(600):
        text = [draw.choice(words) for _ in range(draw.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                text.insert(draw.randint(0, len(text)), draw.choice(bad))
        rows.append((i, " ".join(text) + "."))
        labels.append((i, int(toxic)))
    frame = spark.createDataFrame([*labels, (0, 1), (None, 1), (3, None), (99_999, 1)], "doc_id long, toxic int")
    extra = [(i + 10_000 if i is not None else None, t) for i, t in AWKWARD]
    got = toxicity.toxicity(table(spark, rows + extra), frame).collect()
    assert len(got) == len(rows + extra) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by_id = {r.doc_id: r for r in got}
    truth = dict(labels)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i in truth if by_id[i].held_out} == set(held)
    assert np.mean([by_id[i].predicted == truth[i] for i in held]) > 0.98
    for i, text in rows:
        found = [text[int(a):int(b)] for a, b in (s.split(":") for s in by_id[i].offending.split(",") if s)]
        assert not truth[i] or set(found) <= set(bad)
    kept = toxicity.without_toxic(table(spark, rows + extra), frame)
    assert kept.columns == ["doc_id", "text", "shard", "key", "c0"]
    assert kept.count() == sum(r.score < 0.5 for r in got)
    assert toxicity.toxicity(table(spark, []), frame).count() == 0
    assert {r.score for r in toxicity.toxicity(table(spark, rows[:5]), frame.limit(0)).collect()} == {0.0}


def test_toxicity_on_the_given_table(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").select("score", "toxic").collect()
    high, low = [r.score for r in scored if r.toxic], [r.score for r in scored if not r.toxic]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in high for b in low]) > 0.9


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, block int, row int")


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 700)
    monkeypatch.setattr(ann, "QUERIES", 40)
    draw = np.random.default_rng(3)
    data = draw.normal(size=(2000, 24)).astype(np.float32)
    data[100:160] = data[40]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    odd = [(2020, None), (2040, [0.0] * 24), (2060, [float("nan")] * 24), (2080, [float("inf")] + [1.0] * 23), (2100, [None] * 24), (2120, [1.0]), (None, data[7].tolist())]
    got = ann.nearest(vectors(spark, rows + odd)).collect()
    exact = np.vstack([data, data[7:8]]).astype(float)
    ids = np.array([*range(2000), 10**9])
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(range(0, 2000, 20))
    right = 0
    for q, own in found.items():
        own.sort(key=lambda r: r.rank)
        scores = (exact * exact[q]).sum(1)
        scores[q] = -np.inf
        best = np.lexsort((ids, -scores))[:20]
        right += len({r.vec_id for r in own} & {None if ids[b] == 10**9 else int(ids[b]) for b in best})
        assert [r.rank for r in own] == list(range(1, 21))
        assert [(-r.score, 10**9 if r.vec_id is None else r.vec_id) for r in own] == sorted((-r.score, 10**9 if r.vec_id is None else r.vec_id) for r in own)
        assert all(abs(r.score - scores[ids == (10**9 if r.vec_id is None else r.vec_id)][0]) < 1e-12 for r in own)
    assert right / (20 * len(found)) >= 0.9
    few = ann.nearest(vectors(spark, rows[:4] + odd)).collect()
    assert sorted((r.query_id, r.rank) for r in few) == [(0, k) for k in (1, 2, 3, 4)]
    assert ann.nearest(vectors(spark, odd[:2])).count() == ann.nearest(vectors(spark, [])).count() == 0


def test_scores_equal_plain_recursion(spark):
    draw = random.Random(4)
    rows = [(i, "".join(draw.choice(["ab", "Abc ", "x", " ", "é"]) for _ in range(draw.randint(0, 25)))) for i in range(40)]
    rows += [(100, None), (100, None), (None, "ab ab"), (101, "Zq"), (102, "a\x00b")]
    texts = [(t or "").encode() for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    plain = brute.context_tree([t for t, h in zip(texts, held, strict=True) if not h], 4)
    words = brute.word_scores(texts, [not h for h in held])
    got = ctw.score(table(spark, rows), depth=4, split=2).collect()
    expected = sorted((str(i), h, *w[:3], round(w[3], 6), round(plain(t), 6)) for (i, _), h, t, w in zip(rows, held, texts, words, strict=True))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == expected
    assert ctw.score(table(spark, [])).count() == 0
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    untrained = ctw.score(table(spark, [(alone, "ab")])).collect()
    assert [(r.base_score, r.n_known, r.train_tokens) for r in untrained] == [(0.0, 0, 0)] and abs(untrained[0].score + 24 * math.log10(2)) < 1e-9


def test_probabilities_sum_to_one(spark):
    rows = [(i, "banana bandana") for i in range(10)]
    texts = [t.encode() for _, t in rows]
    strings = np.unique(ctw.strings(texts, 3)[0])
    context = int(strings[5]) >> 8
    keys = np.unique(np.r_[strings, [(context << 8) | b for b in range(256)]])
    counts = dict(zip(*np.unique(ctw.strings(texts, 3)[0], return_counts=True), strict=True))
    frame = spark.createDataFrame([(int(k), int(counts.get(k, 0))) for k in keys], "key long, n long")
    values = {r.key: r.value for r in ctw.values_of(frame, 3, 1).collect()}
    assert abs(sum(10 ** values[(context << 8) | b] for b in range(256)) - 1) < 1e-9


def test_long_texts_are_sliced(monkeypatch):
    text = bytes(random.Random(5).choices(b"abcd", k=5_000))
    whole = ctw.strings([text], 5)[0]
    monkeypatch.setattr(ctw, "SLICE", 999)
    parts = [p for p, _, _ in ctw._packed([text], 5)]
    assert len(parts) > 4 and np.array_equal(np.concatenate(parts), whole)


def repeated(n=40):
    draw = random.Random(6)
    passages = ["".join(draw.choice("abcdefgh é") for _ in range(draw.randint(45, 200))) for _ in range(6)]
    rows = []
    for i in range(n):
        text = "".join(draw.choice("klmnopqr st") for _ in range(draw.randint(0, 150)))
        for _ in range(draw.randint(0, 3)):
            p = draw.choice(passages)
            a = draw.randint(0, 20)
            text += p[a:a + draw.randint(30, 200)] + "".join(draw.choice("xyz") for _ in range(draw.randint(0, 9)))
        rows.append((draw.randint(0, 1000), text))
    line = "the same start of many different lines "
    return rows + [(2000 + i, line + f"{draw.getrandbits(80)}" * 3) for i in range(12)] + [(3000, "z" * 300), (2999, "z" * 60), (3001, rows[0][1]), (3001, rows[0][1]), (None, rows[1][1]), (None, "n" * 80)]


def frames(passes, tables):
    """One pass over grouped tables, as Spark would call it."""
    return pa.concat_tables([passes(*t) for t in tables])


@pytest.mark.parametrize(("many", "hot", "buckets", "blocks"), [(64, 4096, 3, 5), (2, 4096, 2, 4), (3, 5, 3, 6), (1, 1, 4, 3), (64, 1, 2, 7)])
def test_passes_equal_brute_force(monkeypatch, many, hot, buckets, blocks):
    monkeypatch.setattr(pfp, "MANY", many)
    monkeypatch.setattr(pfp, "HOT", hot)
    monkeypatch.setattr(pfp, "SLICE", 700)
    rows = repeated()
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("block", pa.int64())])
    texts = [pa.Table.from_pylist([{"doc_id": d, "text": t, "block": b} for d, t in rows[b::blocks]], schema=schema) for b in range(blocks)]
    by = lambda table, column, value: table.filter(pa.compute.equal(table[column], value))
    sent = frames(pfp._parse_block(buckets), [(t,) for t in texts])
    back = frames(pfp._settle, [(by(sent, "bucket", b),) for b in set(sent["bucket"].to_pylist())])
    words = frames(pfp._dictionary(buckets), [(t, by(back, "block", b)) for b, t in enumerate(texts)])
    if len(words):
        back = pa.concat_tables([back, frames(pfp._order, [(by(words, "bucket", b),) for b in set(words["bucket"].to_pylist())])])
    got = frames(pfp._finish(buckets), [(t, by(back, "block", b)) for b, t in enumerate(texts)]).drop_columns(["spans"]).to_pylist()
    expected = brute.repeats([(d, t.encode()) for d, t in rows])
    assert sorted(map(str, (tuple(r.values()) for r in got))) == sorted(map(str, expected))
    assert sum(r["n_removed"] for r in got) > 1000


def test_repeats(spark):
    rows = repeated() + [(i + 5000 if i is not None else None, t) for i, t in AWKWARD if len(t or "") < 10_000]
    got = pfp.repeats(table(spark, rows)).collect()
    expected = brute.repeats([(d, (t or "").encode()) for d, t in rows])
    assert sorted(str(tuple(r)[:5]) for r in got) == sorted(map(str, expected))
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)
    assert pfp.repeats(table(spark, [])).count() == 0


def test_one_letter_texts_are_whole():
    parse = next(iter(pfp.parses([b"a" * 100, b"b" * 49, b"c" * 50])))
    assert len(parse.first) == 52 and SimpleNamespace(n=set(parse.owner.tolist())).n == {0, 2}


def test_nearest_with_a_third_of_the_rows_equal(spark):
    draw = np.random.default_rng(4)
    data = draw.normal(size=(3000, 24)).astype(np.float32)
    same = draw.permutation(3000)[:1000]
    data[same] = 2 * data[0]
    got = ann.nearest(vectors(spark, [(i, v.tolist()) for i, v in enumerate(data)])).collect()
    found = {q: [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] for q in range(0, 3000, 20)}
    members, right = set(same.tolist()), 0
    for q, own in found.items():
        scores = (data.astype(float) * data[q].astype(float)).sum(1)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(3000), -scores))[:20].tolist()
        right += len(set(own) & set(best))
        if q in members:
            assert own == sorted(members - {q})[:20] == best
    assert right / (20 * len(found)) >= 0.9


def _recall(spark, data, every=20):
    got = ann.nearest(vectors(spark, [(i, v.tolist()) for i, v in enumerate(data)]), every).collect()
    right = 0
    for q in range(0, len(data), every):
        scores = (data.astype(np.float32).astype(float) * data[q].astype(np.float32).astype(float)).sum(1)
        scores[q] = -np.inf
        right += len({r.vec_id for r in got if r.query_id == q} & set(np.lexsort((np.arange(len(data)), -scores))[:20].tolist()))
    return right / len(got)


def test_nearest_of_unequal_norms_and_near_copies(spark):
    draw = np.random.default_rng(6)
    data = draw.normal(size=(4000, 32))
    assert _recall(spark, data * np.exp(0.5 * draw.normal(size=(4000, 1))), 100) >= 0.9
    data[draw.permutation(4000)[:1300]] = data[0] + 1e-3 * draw.normal(size=(1300, 32))
    assert _recall(spark, data, 100) >= 0.95


def test_vectors_of_other_lengths_are_searched_among_their_own(spark):
    draw = np.random.default_rng(7)
    rows = [(i, draw.normal(size=3 + i % 2).tolist()) for i in range(200)] + [(200, [1.0])]
    got = ann.nearest(vectors(spark, rows)).collect()
    assert {r.query_id for r in got} == set(range(0, 200, 20)) and len(got) == 10 * 20
    assert all(r.query_id % 2 == r.vec_id % 2 for r in got)
    repeated = ann.nearest(vectors(spark, [(0, [1.0, 2.0])] * 3 + [(1, [0.5, 0.5])])).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in repeated) == sorted([(0, 1, 0), (0, 2, 0), (0, 3, 1)] * 3)


def test_ctw_writes_no_file_per_shuffle_partition(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(ctw, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(ctw, "keep", lambda df, name: kept.setdefault(name, keep(df, name)))
    draw = random.Random(8)
    docs = spark.createDataFrame([(i, "".join(draw.choices("abcdefgh ", k=4_000))) for i in range(200)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert ctw.score(docs).count() == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(kept["counts"].inputFiles()) <= ctw.bucket_tasks(40, spark.sparkContext.defaultParallelism)
    assert [ctw.bucket_tasks(*x) for x in ((1, 8), (10, 2), (96, 6), (4_000, 6))] == [1, 6, 24, 1000]
