"""Licences, alignment of tokenizers, filter audit: against plain versions, with every awkward input."""

import itertools
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketspark.llm import alignment, audit, licenses
from tests.llm import brute

SCHEMA = "doc_id long, text string, block string, key string, n_words int"  # the last three clash with names in use
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "One"), (4, "One"), (None, "one two three four five"), (5, "É  x"), (6, "w " * 3_000),
    (7, "a" * 5_000), (8, "0.0.0.0 " * 300), (9, "!" * 500), (10, "x\x00y \x1c z"), (None, None), (11, "<|endoftext|> </s> ▁"), (12, "日本語 テキスト 😀"),
]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)


# Licences

VOCABULARY = ["mit", "license", "apache", "general", "public", "lesser", "cc", "by", "nc", "sa", "x", "MIT", "License,", "é"]


def test_places_of_phrases(spark):
    rng = random.Random(1)
    rows = AWKWARD + [(i, " ".join(rng.choices(VOCABULARY, k=rng.randrange(60)))) for i in range(100, 300)]
    rows += [(300, "The MIT-License; (apache license)")] * 2 + [(301, "word " * 250_000 + "mit license")]
    known = licenses.BASE | licenses.NOTICES
    got = {}
    for r in licenses.license_scan(table(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for doc_id, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        line = f" {' '.join(words)} "
        places = [i for phrase in licenses.BASE for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
        base = sorted({licenses.BASE[p] for p in licenses.BASE if f" {p} " in line})
        labels = sorted({known[p] for p in known if f" {p} " in line})
        want = (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(base), ",".join(labels))
        assert want in [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in got[doc_id]]
        assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in got[doc_id])
    assert licenses.license_scan(table(spark, [])).count() == 0


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_parts_do_not_matter(size):
    automaton, text = licenses.build(), b"x the mit license and cc by nc sa mit mit license general public license"
    whole = list(automaton.find([text.split()]))
    assert list(automaton.find(licenses.word_parts(text, size))) == whole and len(whole) > 5


@pytest.mark.parametrize(("line", "text", "freedom"), [
    ("SPDX-License-Identifier: MIT", "MIT", 0.95),
    ("# SPDX-License-Identifier: GPL-2.0-only OR MIT\nAND more", "GPL-2.0-only OR MIT", 0.95),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only", "(MIT OR Apache-2.0) AND GPL-2.0-only", 0.4),
    ("SPDX-License-Identifier: MIT OR Apache-2.0 AND GPL-3.0+", "MIT OR Apache-2.0 AND GPL-3.0+", 0.95),
    ("SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 */", "GPL-2.0-or-later WITH Classpath-exception-2.0", 0.7),
    ('license-expression = "BSD-3-Clause and isc"', "BSD-3-Clause AND isc", 0.95),
    ("(SPDX-License-Identifier: MIT) text", "MIT", 0.95),
    ("SPDX-License-Identifier: MIT This file", "MIT", 0.95),
    ("SPDX-License-Identifier: LicenseRef-own.", "LicenseRef-own", licenses.OTHER),
    ("SPDX-License-Identifier: MIT OR", None, None),
    ("SPDX-License-Identifier: (MIT", None, None),
    ("SPDX-License-Identifier: MIT WITH (a OR b)", None, None),
    ("SPDX-License-Identifier", None, None),
])
def test_expressions(line, text, freedom):
    found = licenses.scan(line, licenses.build())
    (_, value), = found.expressions
    assert (value and value.text) == text and (value and value.freedom) == freedom


def test_statements(spark):
    rows = [(1, "x under the MIT License\nSPDX-License-Identifier: Apache-2.0"), (2, "SPDX-License-Identifier: AND"), (3, None)]
    got = licenses.statements(table(spark, rows)).collect()
    assert sorted(tuple(r) for r in got if r.statement) == [(1, 3, "notice", "mit", 0.95), (1, 5, "expression", "Apache-2.0", 0.9)]
    assert [tuple(r) for r in got if not r.statement] == [(2, 0, "malformed", None, None)]


NAMES = st.sampled_from(["MIT", "GPL-2.0", "Apache-2.0", "Foo"])
TREES = st.recursive(NAMES, lambda inner: st.tuples(st.sampled_from(["AND", "OR"]), inner, inner), max_leaves=12)


def spelled(tree, level=0):
    if isinstance(tree, str):
        return tree, {licenses.label_of(tree)}, licenses.FREEDOM.get(licenses.label_of(tree), licenses.OTHER)
    operator, left, right = tree
    (a, la, fa), (b, lb, fb) = spelled(left, 1), spelled(right, 1)
    text = f"{a} {operator} {b}"
    return (f"({text})" if level else text), la | lb, (max if operator == "OR" else min)(fa, fb)


@settings(max_examples=150, deadline=None)
@given(TREES)
def test_shunting_yard_follows_the_tree(tree):
    text, labels, freedom = spelled(tree)
    value = licenses.evaluate(licenses.postfix(re.findall(r"[()]|[^\s()]+", text)))
    assert value.labels == labels and value.freedom == freedom
    again = licenses.evaluate(licenses.postfix(re.findall(r"[()]|[^\s()]+", value.text)))  # its own text means the same
    assert again.freedom == freedom


# Alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_rows(rows):
    enc = alignment.encoders(*PATHS)
    a = lambda t: [(i, enc.bytes_a[i]) for i in enc._a.encode(" " + t, add_special_tokens=False).ids]
    b = lambda t: [(i, enc.bytes_b[i]) for i in enc._b.encode(t)]
    found = brute.aligned([t for _, t in rows], a, b)
    return sorted((str(i), *values) for (i, _), values in zip(rows, found, strict=True))


@pytest.mark.parametrize("block", [400, 1 << 24])
def test_alignment(spark, block):
    rng = random.Random(2)
    words = ["the", "licence", "Ünïcode", "unbelievable", "1234567", "tokenization", "...", "\n\n", "antidisestablishmentarianism", "x"]
    rows = AWKWARD + [(i, " ".join(rng.choices(words, k=rng.randrange(1, 40)))) for i in range(20, 60)]
    got = alignment.align(table(spark, rows).repartition(2), *PATHS, block).collect()
    assert sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum) for r in got) == plain_rows(rows)
    assert alignment.align(table(spark, []), *PATHS).count() == 0


def test_texts_that_do_not_align_have_no_tokens():
    enc = alignment.Encoders(*PATHS)
    enc.bytes_b = [x.replace(b"a", b"b") for x in enc.bytes_b]  # B spells other bytes
    x = alignment.align_texts(enc, ["a word", "onion", "to be or not to be, a"])
    assert x.n_a[0] == x.n_b[0] == x.n_groups[0] == x.n_links[0] == 0 and x.digests[0] == "" and x.n_a[1] > 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab' 1.\n\té　▁\x1cs")), max_size=25), min_size=1, max_size=5))
def test_words_alone_have_the_ids_of_whole_texts(texts):
    enc = alignment.encoders(*PATHS)
    a, b, n_a, n_b = enc.encode(texts)
    wanted = plain_tokens(texts)
    assert n_a.tolist() == [len(x) for x, _ in wanted] and n_b.tolist() == [len(y) for _, y in wanted]
    assert a.tolist() == [i for x, _ in wanted for i in x] and b.tolist() == [i for _, y in wanted for i in y]


def test_words_are_forgotten_without_harm(monkeypatch):
    monkeypatch.setattr(alignment, "WORDS", 40)
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.choice([1, 2, rng.randrange(500)])}" for _ in range(30)) for _ in range(40)]
    enc, wanted = alignment.Encoders(*PATHS), plain_tokens(texts)
    for text, (x, y) in zip(texts, wanted, strict=True):
        a, b, *_ = enc.encode([text])
        assert a.tolist() == x and b.tolist() == y
    assert len(enc._words) < 100


def plain_tokens(texts):
    enc, out = alignment.encoders(*PATHS), []
    for text in texts:
        a, b = enc._a.encode(" " + text, add_special_tokens=False).ids, enc._b.encode(text)
        whole = (" " + text).encode()
        good = text and b"".join(enc.bytes_a[i] for i in a) == whole == b"".join(enc.bytes_b[i] for i in b)
        out.append((a, b) if good else ([], []))
    return out


def test_every_text_of_the_given_tables_has_the_same_ids(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    a, b, n_a, n_b = alignment.Encoders(*PATHS).encode(texts)
    wanted = plain_tokens(texts)
    assert a.tolist() == [i for x, _ in wanted for i in x] and b.tolist() == [i for _, y in wanted for i in y]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(61, 70)), min_size=1, max_size=4))
def test_common_ends(texts):
    ea, eb, first, last, base = [], [], [], [], 0
    for a, b, end in texts:
        first.append(len(ea))
        ea += [base + x for x in sorted(a)] + [base + end]
        eb += [base + x for x in sorted(b)] + [base + end]
        last.append(len(ea) - 1)
        base += end
    got = alignment.common_ends(*(np.array(x, dtype=np.int64) for x in (ea, eb, first, last)))
    assert got.tolist() == [x in set(eb) for x in ea]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 100_000)))
def test_packed_numbers(numbers):
    assert alignment.unpack(*alignment.pack(np.array(numbers, dtype=np.int64))).tolist() == sorted(numbers)


def test_groups_and_pairs(spark):
    rows = [(1, "unbelievable tokenization"), (2, None), (3, "unbelievable")]
    enc = alignment.encoders(*PATHS)
    for doc_id, text in rows:
        groups = alignment.aligned_groups(table(spark, rows), *PATHS).where(f"doc_id = {doc_id}").orderBy("start").collect()
        assert b"".join(enc.bytes_a[i] for g in groups for i in g.a_ids) == (b" " + text.encode() if text else b"")
        for g in groups:
            assert b"".join(enc.bytes_a[i] for i in g.a_ids) == b"".join(enc.bytes_b[i] for i in g.b_ids)
            assert len(b"".join(enc.bytes_a[i] for i in g.a_ids)) == g.end - g.start
    total = alignment.pair_counts(table(spark, rows), *PATHS).agg(F.sum("n")).first()[0]
    assert total == sum(r[4] for r in plain_rows(rows))


# Filter audit

def write(spark, path, rows, files):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, key int, mask int")
    df.repartition(files).write.parquet(path)


@pytest.mark.parametrize("steps", [1, 4])
def test_audit(spark, tmp_path, steps):
    rng = random.Random(3)
    pool = [None, "", "short", "a|b", "SHOUT " * 250, " ".join(f"w{i}" for i in range(220)), " ".join(f"W{i}" for i in range(220)), "same " * 300]
    rows = [(rng.choice([None, *range(60)]), rng.choice(pool), rng.choice([None, "", "en", "de"]), 1, 1) for _ in range(300)]
    rows += [(1, "short", "fr", 1, 1)] * 3
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in [*range(40), 5, 6, None]]
    path = str(tmp_path / f"docs{steps}.parquet")
    write(spark, path, rows, 6)
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.audit(spark, path, labelled, steps).collect()
    want = brute.audit([r[:3] for r in rows], labels)
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == want
    assert len(got) == 600 * len({r[2] or "" for r in rows})
    retracted = audit.changes(spark, path, steps).where("delta < 0").count()
    assert steps == 1 or retracted > 0


def test_audit_of_nothing(spark, tmp_path):
    path = str(tmp_path / "none.parquet")
    write(spark, path, [], 1)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(spark, path, labels).count() == 0


def test_orders_are_all_permutations():
    assert {o["filter_order"] for o in audit.orders()} == {"".join(p) for p in itertools.permutations("ABCDE")}
