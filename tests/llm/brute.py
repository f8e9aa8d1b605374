"""Plain versions of the operators' results, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ascii_lower(text):
    return (text or "").translate(_LOWER)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def contamination(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        words = word.findall(ascii_lower(text))
        for k in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[k:k + 10])].add(item)
    out = []
    for doc, text in docs:
        words, hit, found = word.findall(ascii_lower(text)), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if own := windows.get(tuple(words[k:k + size])):
                    hit.update(range(k, k + size))
                    found |= own
        named = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(words), len(hit), len(named), sha(",".join(named)), bool(hit)))
    return out


def fingerprint(text, shingle=4):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", ascii_lower(text)) if w]
    parts = [" ".join(words[k:k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def classes(links, nodes):
    """The least member of each node's component."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near(values, bits=4):
    return [(a, b) for i, a in enumerate(values) for b in values[i + 1:] if (a ^ b).bit_count() <= bits]


def jump(key, shards):
    b, j, key = -1, 0, key % 2**64
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(s):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(s))) % 10 == 0

    checks = {
        "email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
        "card": lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s)), "phone": lambda s: 8 <= len(digits(s)) <= 15,
    }
    return [(k, m.start(), m.end()) for k in FORMS for m in re.finditer(FORMS[k], text or "") if checks[k](m[0])]


def repeats(docs, length=50):
    """docs: (doc_id, bytes)."""
    first = {}
    for doc, text in docs:
        for p in range(len(text) - length + 1):
            string = text[p:p + length]
            first[string] = min(first.get(string, math.inf), math.inf if doc is None else doc)
    out = []
    for doc, text in docs:
        mask = np.zeros(len(text), dtype=bool)
        for p in range(len(text) - length + 1):
            if first[text[p:p + length]] < (math.inf if doc is None else doc):
                mask[p:p + length] = True
        spans = int((np.diff(np.r_[0, mask.astype(np.int8)]) == 1).sum())
        out.append((doc, len(text), int(mask.sum()), spans, sha(np.frombuffer(text, np.uint8)[~mask].tobytes())))
    return out


def context_tree(training, depth):
    """A function: log10 probability of a text (bytes, with its end) after training texts; plain recursion."""
    counts = defaultdict(lambda: [0, 0])  # (context, bits before) -> zeros, ones
    children = defaultdict(set)

    def decisions(text):
        padded = bytes(depth) + text + b"\0"
        for p in range(depth, len(padded)):
            for bit in range(8):
                yield padded[p - depth:p], (bit, padded[p] >> (8 - bit)), padded[p] >> (7 - bit) & 1

    for text in training:
        for context, node, one in decisions(text):
            for d in range(depth + 1):
                counts[context[depth - d:], node][one] += 1
                if d:
                    children[context[depth - d + 1:], node].add(context[depth - d:])

    def own(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    memo = {}

    def weighted(context, node):
        if (context, node) not in memo:
            le = own(*counts[context, node])
            if len(context) == depth:
                memo[context, node] = le, 1.0
            else:
                below = sum(weighted(c, node)[0] for c in children[context, node])
                top = max(le, below)
                memo[context, node] = top + math.log(0.5 * math.exp(le - top) + 0.5 * math.exp(below - top)), 1 / (1 + math.exp(min(700, below - le)))
        return memo[context, node]

    def chance(context, node, one, d, parent):
        key = context[depth - d:], node
        a, b = counts.get(key, (0, 0))
        if a + b == 0:
            return parent
        kt = ((b if one else a) + 0.5) / (a + b + 1)
        share = weighted(*key)[1]
        return kt if d == depth else share * kt + (1 - share) * chance(context, node, one, d + 1, kt)

    return lambda text: sum(math.log10(chance(c, n, o, 0, 0.5)) for c, n, o in decisions(text))


def word_scores(docs, training):
    """docs: texts as bytes; training: which of them count."""
    words = [[*t.lower().split(), b""] for t in docs]
    counts = Counter(w for ws, t in zip(words, training, strict=True) if t for w in ws)
    total = sum(counts.values())
    scale = total + 0.5 * (len(counts) + 1)
    return [(len(ws), sum(counts[w] > 0 for w in ws), total, sum(math.log10((counts[w] + 0.5) / scale) for w in ws)) for ws in words]


def aligned(texts, encode_a, encode_b):
    """Per text: n_a, n_b, n_groups, n_links, digest, n_best, count_sum. The encoders give (id, bytes) lists."""
    found = []
    for text in texts:
        whole = b" " + (text or "").encode()
        a, b = (encode(text) if text else [] for encode in (encode_a, encode_b))
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a, b = [], []
        spans = []
        for tokens in (a, b):
            place, out = 0, []
            for i, x in tokens:
                out.append((place, place + len(x), i))
                place += len(x)
            spans.append(out)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = []
        for start, stop in zip([0, *cuts], cuts, strict=False):
            sides = [",".join(str(i) for s, e, i in side if start <= s and e <= stop) for side in spans]
            groups.append("|".join(sides))
        links = [(i, j) for s, e, i in spans[0] for t, f, j in spans[1] if s < f and t < e]
        found.append((len(a), len(b), len(cuts), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "", links))
    counts = Counter(link for *_, links in found for link in links)
    top = {}
    for (_, j), n in counts.items():
        top[j] = max(n, top.get(j, 0))
    return [
        (n_a, n_b, n_groups, len(links), digest, sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links))
        for n_a, n_b, n_groups, digest, links in found]


def audit(docs, labels):
    """docs: doc_id, text, lang; labels: doc_id, quality, toxic. (part, order, step) -> the seven counts."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails, known = [], {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            known[text or ""] = min(doc_id, known.get(text or "", doc_id))
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": doc_id is not None and known[text] < doc_id}
        fails.append((lang or "", doc_id, {k for k, v in failed.items() if v}))
    out, removed_by = {}, Counter()
    for order in itertools.permutations("ABCDE"):
        for step, own in enumerate(order, 1):
            before = set(order[:step - 1])
            for part in {p for p, _, _ in fails}:
                rows = [(i, f) for p, i, f in fails if p == part]
                removed = [(i, f) for i, f in rows if own in f and not f & before]
                removed_by[part, own] += len(removed)
                out[part, "".join(order), step] = [
                    sum(not f & {own, *before} for _, f in rows), len(removed), sum(own in f and bool(f & before) for _, f in rows),
                    sum(f == {own} for _, f in rows), sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed)]
    return {(p, o, s): (*v, removed_by[p, o[s - 1]]) for (p, o, s), v in out.items()}
