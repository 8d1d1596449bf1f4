"""Ranked search, fill-in-middle and personal data, against plain versions."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglattice.llm import crf, infill, lexical, pii, wavelet

DOCS = "doc_id bigint, text string, lang string, key bigint, h1 string, number int, spans string, draw int"
TERM = "[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def make(spark, rows):
    return spark.createDataFrame([(i, t, None, 7, "h", 1, "s", 2) for i, t in rows], DOCS)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_search(docs, items, top):
    docs = [(i, Counter(re.findall(TERM, lower(t)))) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    n_all, length = len(docs), sum(sum(c.values()) for _, c in docs)
    held = Counter(w for _, c in docs for w in c)
    out = []
    for item, text in items:
        asked = Counter(re.findall(TERM, lower(text)))
        scored = []
        for i, c in docs:
            m = 100 - 75 + (75 * sum(c.values()) * n_all) // length
            score = sum(
                times * math.floor(1000 * math.log((2 * n_all + 2) / (2 * held[w] + 1)))
                * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m))
                for w, times in asked.items() if w in c
            )
            if score > 0:
                scored.append((-score, math.inf if i is None else i))
        out += [(item, r + 1, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def search_rows(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def prose(draw, n, words=300):
    return " ".join(f"w{int(draw.paretovariate(0.6)) % words}" for _ in range(n))


@pytest.mark.parametrize(("bucket", "share", "block"), [(512, 0.02, 1_000_000), (4, 0.3, 60)])
def test_ranked_search_equals_the_plain_version(spark, bucket, share, block):
    draw = random.Random(3)
    docs = [(i, prose(draw, draw.choice([1, 5, 40, 200]))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)] + [(5, "w1 w2 w3"), (5, "w1 w2 w3"), (None, "w4 W5 É"), (900, None), (901, ""), (902, "?!")]
    docs.append((903, "w1 " * 5000))
    items = [(i, prose(draw, 30)) for i in range(12)] + [(50, docs[7][1]), (51, None), (52, "nowhere"), (53, "w1 w1 É"), (50, "w4")]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    out = lexical.ranked_search(make(spark, docs).repartition(3), asked, bucket=bucket, first_share=share, block_terms=block)
    assert search_rows(out) == plain_search(docs, items, 10)


def test_ranked_search_of_empty_tables(spark):
    some = make(spark, [(1, "a b")])
    asked = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical.ranked_search(some.filter("doc_id < 0"), asked).count() == 0
    assert lexical.ranked_search(some, asked.filter("item_id < 0")).count() == 0
    assert search_rows(lexical.ranked_search(some, asked))[0][:3] == (1, 1, 1)


def test_pruned_buckets_hold_no_better_document():
    draw = np.random.default_rng(5)
    n, terms = 600, 40
    dense = draw.integers(0, 9, (n, terms)) * (draw.random((n, terms)) < 0.2)
    weights = np.ones(terms, np.int64)
    asked = [np.sort(draw.choice(terms, 12, replace=False)) for _ in range(8)]
    counts = [draw.integers(1, 4, 12) for _ in asked]
    items = lexical.Items(asked, counts, weights, np.ones(8, np.int64), 5)
    lengths = np.sqrt((dense**2).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    for at in range(0, n, 50):
        part = order[at : at + 50]
        owner, term = np.nonzero(dense[part])
        bucket = lexical.Bucket(part, lengths[part], owner, term, dense[part][owner, term])
        for q in range(8):
            bucket.search(items, q)
    for q in range(8):
        scores = dense[:, asked[q]] @ counts[q]
        best = np.lexsort((np.arange(n), -scores))[:5]
        assert items.keys[q].tolist() == best.tolist() and items.scores[q].tolist() == scores[best].tolist()


def test_wavelet_ranks():
    draw = np.random.default_rng(1)
    classes = draw.integers(0, 5, 1000).astype(np.uint8)
    matrix = wavelet.WaveletMatrix(classes, 3)
    upto = np.r_[0, 63, 64, 65, draw.integers(0, 1001, 50), 1000]
    for c in range(6):
        assert matrix.rank(c, upto).tolist() == [int((classes[:u] == c).sum()) for u in upto]
    assert wavelet.WaveletMatrix(np.empty(0, np.uint8), 3).rank(2, np.zeros(2, np.int64)).tolist() == [0, 0]


def plain_cut(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n, digest = len(units), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted([h[0] % (n + 1), h[1] % (n + 1)])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle_equals_the_plain_version_and_gives_texts_back(spark):
    draw = random.Random(2)
    alphabet = "ab Zé\n9<>PSM日😀-"
    docs = [(i, "".join(draw.choice(alphabet) for _ in range(draw.choice([1, 2, 3, 70])))) for i in range(300)]
    docs += [(500, None), (501, ""), (None, "no id here"), (7, "same id"), (7, "same id"), (502, "x" * 300_000), (503, "é" * 90_000),
             (504, "<" * 500 + "P>")]
    out = infill.fill_in_middle(make(spark, docs).repartition(3)).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect()), key=str)
    assert got == sorted((plain_cut(*d) for d in docs), key=str)
    assert sorted((str(r.doc_id), r.back) for r in out.collect()) == sorted((str(i), t or "") for i, t in docs)
    assert {r.form for r in out.collect()} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(make(spark, docs).filter("doc_id < 0")).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for place, c in enumerate(reversed(digits)):
        v = int(c) * (1 + place % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {
                "email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 12 <= len(digits) <= 19 and plain_luhn(digits), "phone": 9 <= len(digits) <= 15,
            }
            if fits[kind]:
                out.append((m.start(), pii.KINDS.index(kind), m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    draw = random.Random(4)
    pieces = ["a.b@c.de", "@", "x@y", ".com", "1.2.3.4", "300", ".", "4111 1111 1111 1111", "+1 (499) 555-6503", "-", " ", "é", "12",
              "0001.2.3.4.5", "+", "a@b.c@d.e", "4111111111111111", "1 2"]
    for _ in range(3000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randrange(1, 12)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("") == [] and pii.base_spans("1" * 200_000 + "@" * 1000 + "a" * 100_000) == []


def small_weights(seed, labels=3, features=4):
    draw = np.random.default_rng(seed)
    skip = draw.normal(size=(labels, labels))
    return crf.Weights(draw.normal(size=(features, labels)), draw.normal(size=(labels, labels)), (skip + skip.T) / 2)


def exact_marginals(graph, weights, known):
    n, labels = len(graph.features), weights.node.shape[1]
    own, total = graph.features @ weights.node, np.zeros((n, labels))
    for y in itertools.product(range(labels), repeat=n):
        if any(k >= 0 and k != v for k, v in zip(known, y, strict=True)):
            continue
        score = sum(own[i, v] for i, v in enumerate(y) if known[i] < 0)
        score += sum(weights.chain[y[a], y[b]] for a, b in graph.chain) + sum(weights.skip[y[a], y[b]] for a, b in graph.skip)
        total[np.arange(n), y] += math.exp(score)
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("seed", range(4))
def test_beliefs_are_exact_without_loops_and_near_with_them(seed):
    draw = np.random.default_rng(seed)
    weights = small_weights(seed)
    features = draw.random((6, 4)) < 0.5
    known = np.array([-1, 2, -1, -1, -1, -1])
    tree = crf.Graph(features, np.array([[0, 1], [1, 2], [3, 4]]), np.array([[2, 5], [0, 3]]))
    exact = exact_marginals(tree, weights, known)
    assert np.allclose(crf.marginals(tree, weights, known, rounds=200)[known < 0], exact[known < 0], atol=5e-3)
    loops = crf.Graph(features, np.array([[0, 1], [1, 2], [3, 4], [4, 5]]), np.array([[0, 3], [2, 5]]))
    assert np.abs(crf.marginals(loops, weights, known, rounds=200) - exact_marginals(loops, weights, known))[known < 0].max() < 0.1


def test_repeated_entities_share_their_label(spark):
    numbers = random.Random(6)
    docs = []
    for i in range(300):
        area, last = numbers.randrange(100, 999), numbers.randrange(1000, 9999)
        lines = [f"call +1 ({area}) 555-{last} now", f"version {i % 7}.0 of {i} in {1990 + i % 30}", f"host 10.{i % 200}.3.{i % 250} up"]
        if i % 2:
            lines.append(f"order {50_000 + i} and once more {50_000 + i} of 10.{i % 200}.3.{i % 250}")
        if i % 3 == 0:
            lines.append(f"again +1 ({area}) 555-{last}")
        docs.append((i, "\n".join(lines)))
    docs += [(1000, "call +1 (499) 555-6503 or, as ever, 499-555-6503 and 4995556503"), (1001, "only 499-555-6503 and 2.0"), (1002, None), (1003, "")]
    docs += [(1004, "9 " * 30_000), (1005, "clean text"), (1005, "clean text"), (None, "ask a.b@c.de")]
    table = make(spark, docs).repartition(3)
    weights = pii.train(table.filter("doc_id < 300"))
    out = {(r.doc_id, tuple(map(tuple, r.base))): r for r in pii.find_personal_data(table, weights).collect()}
    texts = dict(docs)
    for (i, base), r in out.items():
        assert [(s, pii.KINDS.index(k), e) for k, s, e in base] == plain_spans(texts[i])
        assert set(base) <= set(map(tuple, r.spans))
    found = next(r for (i, _), r in out.items() if i == 1000)
    assert [texts[1000][s.start : s.end] for s in found.spans] == ["+1 (499) 555-6503", "499-555-6503", "4995556503"]
    assert all(r.spans == r.base for (i, _), r in out.items() if i in (1001, 1002, 1003, 1005))
    again = pii.train(table.filter("doc_id < 300").repartition(5))
    assert np.array_equal(weights.node, again.node) and np.array_equal(weights.skip, again.skip)


def test_personal_data_of_an_empty_table(spark):
    assert pii.find_personal_data(make(spark, [(1, "a")]).filter("doc_id < 0")).count() == 0
