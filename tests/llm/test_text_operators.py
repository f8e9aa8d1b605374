"""Sharding, BPE, SimHash, decontamination, personal data: against plain versions, with every awkward input."""

import random
import zlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import Row
from pyspark.sql import functions as F

from marketspark.llm import bpe, decontaminate, pii, sharding, simhash
from marketspark.llm.components import components
from tests.llm import brute

SCHEMA = "doc_id long, text string, shard string, key string, c0 int"  # the last three clash with names in use


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)


AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "One"), (4, "One"), (None, "one two three four five"), (5, "É  x"), (6, "w " * 30_000),
    (7, "a" * 70_000), (8, "0.0.0.0 " * 3_000), (9, "!" * 5_000), (10, "x\x00y \x1c z"), (None, None),
]


def test_jump_and_slots(spark):
    rows = [(i * 7919, "t" * (i % 50)) for i in range(-300, 700)] + AWKWARD + [(5, "same")] * 20
    got = sharding.shard_documents(table(spark, rows), 40).collect()
    assert len(got) == len(rows)
    expected = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), brute.jump(i or 0, 40), brute.jump(i or 0, 41)) for i, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == expected
    assert all(r.grown_shard in (r.shard, 40) and r.law == "key" for r in got)
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert sharding.shard_documents(table(spark, []), 40).count() == 0


@pytest.mark.parametrize("shards", [1, 2, 17, 500])
def test_jump_counts(spark, shards):
    for r in sharding.assign(spark.range(-100, 100), "id", shards).collect():
        assert (r.shard, r.grown_shard) == (brute.jump(r.id, shards), brute.jump(r.id, shards + 1))


def test_text_keys_and_files(spark, tmp_path):
    df = spark.createDataFrame([(f"k{i}", i) for i in range(200)] + [(None, -1)], "name string, n int")
    assigned = sharding.assign(df, "name", 8)
    sharding.write_shards(assigned, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(back.select("n", "shard").collect()) == sorted(assigned.select("n", "shard").collect())
    assert assigned.where("n = -1").first().shard == brute.jump(0, 8)


@pytest.fixture(scope="module")
def vocabulary():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = bpe.codec(path, public_tokenizers.PATTERN)
    return path, own, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def test_bpe_equals_the_library(vocabulary):
    _, own, library = vocabulary
    draw = random.Random(3)
    bits = [" ", "  ", "\n", " \n", "\t", "\x1c", "\x85", " ", "'s", "'ll", "the", "é", "日本", "😀", "1", "²", "٣", "!", ".", "\x00", "ab" * 40, "antidis", " "]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 30))) for _ in range(800)]
    texts += [t or "" for _, t in AWKWARD] + ["<|endoftext|>", "ab" * 20_000, " " * 3_000, "é" * 3_000]
    for text, found in zip(texts, own.batched(texts), strict=True):
        assert [i for e in found for i in e[0]] == library.encode_ordinary(text)
        assert b"".join(e[2] for e in found) == text.encode()


def test_bpe_remembers_only_what_comes_again(vocabulary):
    path, _, library = vocabulary
    own = bpe.Codec(bpe.codec(path, public_tokenizers.PATTERN).ranks, public_tokenizers.PATTERN)
    draw = random.Random(9)
    often = ["".join(draw.choice("aeinst") for _ in range(9)) for _ in range(50)]
    for k in range(5):
        texts = [" ".join([f"x{k}x{i}qz,", *draw.sample(often, 8), f"y{k}y{i}zq"]) for i in range(400)]
        assert own.encoded(texts).to_pylist() == [library.encode_ordinary(t) for t in texts]
    held = sum(len(store) for store in vars(own).values() if isinstance(store, dict) and store and isinstance(next(iter(store)), str))
    assert held <= 2 * len(often)


def test_bpe_arrays(vocabulary):
    _, own, library = vocabulary
    texts = ["", " ", "a  b", " a b", "a b ", "one two", "one\n\ntwo three", "é è\x85 ê", "x" * 100 + " y"]
    ids = own.encoded(texts)
    assert ids.to_pylist() == [library.encode_ordinary(t) for t in texts]
    assert own.decoded(ids).to_pylist() == [t.encode() for t in texts]
    assert own.decimal(ids).to_pylist() == [" ".join(map(str, x)) for x in ids.to_pylist()]


def test_forest_equals_single_tree(vocabulary):
    _, own, _ = vocabulary
    draw = random.Random(4)
    pieces = [bytes(draw.choice(b"aeinst rhl\xc3\xa9") for _ in range(draw.randint(1, 32))) for _ in range(3_000)]
    whole = [p for p in pieces if p not in own.ranks]
    assert own._forest.merge(whole) == [tuple(bpe.merge(p, own.ranks)) for p in whole]


def test_bpe_frames(spark, vocabulary):
    path, own, library = vocabulary
    got = sorted(map(str, bpe.token_digests(table(spark, AWKWARD), path, public_tokenizers.PATTERN).collect()))
    ids = [(i, library.encode_ordinary(t or "")) for i, t in AWKWARD]
    expected = [Row(doc_id=i, n_tokens=len(x), ids_sha256=brute.sha(" ".join(map(str, x))), decoded_sha256=brute.sha(library.decode_bytes(x))) for i, x in ids]
    assert got == sorted(map(str, expected))
    kept = bpe.tokenize(table(spark, AWKWARD), path, public_tokenizers.PATTERN, "doc_id", "c0").collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids) for r in kept) == sorted((str(i), len(x), x) for i, x in ids)
    assert bpe.token_digests(table(spark, []), path, public_tokenizers.PATTERN).count() == 0


def test_components(spark):
    draw = random.Random(5)
    links = [(draw.randint(0, 400), draw.randint(0, 400)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(60)] + [(7, 7), (-5, 3)]
    real = [(a, b) for a, b in links if a != b]
    expected = brute.classes(real, {n for link in real for n in link})
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints():
    draw = random.Random(6)
    texts = [t for _, t in AWKWARD if len(t or "") < 1000] + [" ".join(draw.choice(["a", "B", "c ", "dd", "É"]) for _ in range(n)) for n in range(12)]
    for text in texts:
        assert simhash.fingerprint(text, 4) % 2**64 == brute.fingerprint(text)


@pytest.mark.parametrize("bits", [0, 3, 4, 5])
def test_posting_sets_cover(bits):
    from itertools import combinations
    sets = simhash.posting_sets(bits)
    assert all(any(set(s) <= set(c) for s in sets) for c in combinations(range(8), 8 - bits))


@pytest.mark.parametrize(("bits", "long"), [(4, 64), (4, 2), (3, 2)])
def test_links_have_the_components_of_all_pairs(spark, monkeypatch, bits, long):
    monkeypatch.setattr(simhash, "LONG", long)
    draw = random.Random(7)
    centres = [draw.getrandbits(64) for _ in range(6)]
    values = {0, 2**63}
    for c in centres:
        for _ in range(15):
            values.add(c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))))
    signed = [v - 2**64 if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    expected = brute.classes(brute.near(sorted(values), bits), values)
    got = {r.fingerprint % 2**64: r.root for r in simhash.groups(prints, bits).collect()}
    assert len(got) == len(values)
    by_root, by_class = {}, {}
    for v in values:
        by_root.setdefault(got[v], set()).add(v)
        by_class.setdefault(expected[v], set()).add(v)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_class.values()))


def documents(n=60):
    draw = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(draw.choices(words, k=draw.randint(3, 120))) for _ in range(n)]
    copies = [t.replace("w1 ", "w2 ", 1) + " w9" for t in base[:20]]
    return [(i + 100, t) for i, t in enumerate(base + copies + base[:5])]


def test_the_link_search_broadcasts_nothing(spark):
    prints = spark.range(500).selectExpr("id * 7 as fingerprint", "id as doc_id")
    for df in (simhash.links(prints, 4), simhash.label(prints, 4)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Broadcast" not in text


def test_near_duplicates_and_keep_one(spark):
    rows = documents() + [(i, t) for i, t in AWKWARD if len(t or "") < 1000]
    prints = [brute.fingerprint(t) for _, t in rows]
    roots = brute.classes(brute.near(sorted(set(prints))), set(prints))
    least = {}
    for (doc, _), p in zip(rows, prints, strict=True):
        if doc is not None:
            least[roots[p]] = min(least.get(roots[p], doc), doc)
    got = simhash.near_duplicates(table(spark, rows)).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted(map(key, got)) == sorted(key((d, f"{p:016x}", least.get(roots[p]))) for (d, _), p in zip(rows, prints, strict=True))
    kept = simhash.keep_one(table(spark, rows))
    assert kept.columns == ["doc_id", "text", "shard", "key", "c0"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(least.get(r)) for r in set(roots.values()))
    assert simhash.keep_one(table(spark, [])).count() == simhash.near_duplicates(table(spark, [])).count() == 0


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog near a river bank"), (2, "Short item here"), (None, "nameless phrase of five words"),
    (3, None), (4, ""), (5, "of"), (5, "of"), (10, "THE quick brown fox jumps over the lazy dog near"), (6, "É accents ÉTÉ stay upper in the É words they say"),
    (7, "absentterm quick brown fox jumps over the lazy dog near"),
]


def test_contamination(spark):
    a = "the QUICK brown, fox-jumps over the lazy dog near a river bank"
    docs = AWKWARD + [
        (20, f"x {a} y"), (21, a.replace("fox", "cat")), (22, f"{a} short item here {a}"), (23, "nameless phrase of five words"), (24, f"x {a} y"),
        (25, "é accents été stay upper in the é words they say"), (26, "É accents ÉTÉ stay upper in the É words they say"), (27, "- short  item\nhere"),
        (28, "the quick brown fox jumps over the lazy dog near near"), (29, "of of of"),
    ]
    items = spark.createDataFrame([(i, t, "k") for i, t in ITEMS], "item_id long, text string, phrase string")
    got = decontaminate.contamination(table(spark, docs), items).collect()
    key = lambda r: tuple(map(str, r))
    expected = brute.contamination(docs, ITEMS)
    assert sorted(map(key, got)) == sorted(map(key, expected))
    assert sum(r.contaminated for r in got) >= 6
    kept = decontaminate.clean(table(spark, docs), items)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in expected if not r[-1])
    assert kept.columns == ["doc_id", "text", "shard", "key", "c0"]
    assert decontaminate.contamination(table(spark, []), items).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(table(spark, docs), items.limit(0)).collect())


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta x gamma"), (2, "gamma alpha beta"), (3, "alpha beta x x x x x x x x gamma"), (4, "alpha")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    keys = {r.key: r.doc_id for r in docs.select("doc_id", decontaminate.text_key(F.col("text")).alias("key")).collect()}
    for slop, expected in ((1, set()), (5, {1, 2}), (20, {1, 2, 3})):
        assert {keys[r.key] for r in decontaminate.near_matches(docs, items, slop).collect()} == expected


def test_base_spans_equal_the_patterns():
    draw = random.Random(9)
    bits = ["a", "B.c", "@", ".", "-", "1", "22", "255.", "256", "4111111111111111", "4111 1111 1111 1111", "+1 (555) 010-9999", "+", " ", "é", "x@y.z", "%", "\n", "(", "1.2.3.4", "0" * 20]
    for _ in range(4_000):
        text = "".join(draw.choice(bits) for _ in range(draw.randint(0, 14)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == brute.base_spans(text), text
    for text in ("a" * 300_000, "9" * 300_000, "+1" + " " * 300_000, "@" * 100_000, "a@" * 100_000, "1." * 100_000):
        pii.mentions(text, pii.base_spans(text))  # time in proportion to the text


def test_bootstrap(spark):
    seeds = [(i + 200, f"word word tel: +1 555 010 {1000 + i} more the end, mail to user{i}@mail.example.com now") for i in range(8)]
    docs = seeds + [(50, "tel: 555 010 7777 unseen form"), (51, "the 555 010 8888 stays"), (52, "to 12345678 stays"), (53, "tel: 99"), (54, "to to to to nobody")] + AWKWARD
    got = {r.doc_id: r for r in pii.personal_data(table(spark, docs)).collect()}
    assert got[50].spans == "phone:5:17" and got[50].n_phone == 0
    for i, t in docs:
        base = brute.base_spans(t)
        if i is not None and i not in (50,):
            assert got[i].spans == ",".join(f"{k}:{a}:{b}" for k, a, b in base)
            assert got[i].base_sha256 == brute.sha(got[i].spans)
            assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in base) for k in pii.KINDS]
    redacted = {r.doc_id: r for r in pii.redacted(table(spark, docs)).collect()}
    assert redacted[50].text == "tel: [PHONE] unseen form" and redacted[51].text == "the 555 010 8888 stays"
    assert redacted[200].text == "word word tel: [PHONE] more the end, mail to [EMAIL] now"
    assert redacted[1].text is None and redacted[2].text == ""
    assert pii.personal_data(table(spark, [])).count() == pii.redacted(table(spark, [])).count() == 0


def test_redaction_recounts_characters(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cd", 99), (2, None, None)], "doc_id long, text string, n_chars long")
    assert sorted(pii.redacted(docs).collect()) == [(1, "mail [EMAIL]", 12), (2, None, None)]


def test_long_cues(spark):
    url, line = "https://www.example.com/account/contact?user={}&lang=en&phone=", "{{\"id\":{},\"note\":\"a compact line of values\",\"phone\":\""
    unspaced, word = "说明文字没有任何空格因此提示前面的附着文本总是超过四十个字符而且每一次都不相同第{}号联系电话", "w" * 50 + "/{}/fax= "
    docs, expected = [], {}
    for n, cue in enumerate((url, line, unspaced, word)):
        docs += [(100 * n + i, f"see {cue.format(i)}+1 555 01{n} {1000 + i}") for i in range(8)]
        docs.append((100 * n + 50, f"see {cue.format(50)}555 01{n} 7777"))
        start = 4 + len(cue.format(50))
        expected[100 * n + 50] = f"phone:{start}:{start + 12}"
    got = {r.doc_id: r.spans for r in pii.personal_data(table(spark, docs)).collect()}
    assert {i: got[i] for i in expected} == expected


def test_endings_are_the_same_in_both_languages(spark):
    draw = random.Random(10)
    bits = ["a", "Z9", "é", "电话", "\U0001f600", ":", "=", "_", "\x7f", "\x85", "\u2028", "^", "`", "{", "(", "phone", "x" * 39]
    words = ["".join(draw.choice(bits) for _ in range(draw.randint(1, 30))) for _ in range(500)]
    got = spark.createDataFrame([(w,) for w in words], "word string").select("word", pii._words("word").alias("p")).collect()
    assert len(got) == 500 and all(r.p == pii._patterns(r.word + " ", len(r.word) + 1) for r in got)


def test_found_values_support_patterns(spark):
    docs = [(i, f"at tel: +1 555 010 {1000 + i}") for i in range(8)] + [(10 + i, f"at tel: 555 010 {2000 + i}") for i in range(4)]
    docs += [(20 + i, f"at Fon: 555 010 {2000 + i}") for i in range(4)] + [(30 + i, f"at Fon: 555 010 {3000 + i}") for i in range(3)]
    docs += [(40 + i, f"at Rufnr: 555 010 {3000 + i}") for i in range(3)] + [(50, "at Rufnr: 555 010 4000"), (51, "at Los: 555 010 4001")]
    got = {r.doc_id: r.spans for r in pii.personal_data(table(spark, docs)).collect()}
    for i, t in docs:
        assert got[i] == ("" if i == 51 else f"phone:{t.index(': ') + 2}:{len(t)}"), t


def test_proximity_of_all_terms(spark):
    docs = spark.createDataFrame([(1, "zeta beta gamma alpha delta"), (2, "alpha beta gamma x"), (3, "delta zeta"), (4, "delta zeta")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma delta zeta"), (2, "alpha beta gamma absent")], "item_id long, text string")
    keys = {r.key: r.doc_id for r in docs.select("doc_id", decontaminate.text_key(F.col("text")).alias("key")).collect()}
    found = decontaminate.near_matches(docs, items, 5).collect()
    assert {(keys[r.key], r.phrase) for r in found} == {(1, "alpha beta gamma delta zeta")}
