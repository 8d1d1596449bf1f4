"""Line dedup, licence scans, substring dedup and near-dedup of texts, against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from loglattice.llm import licenses, linededup, minhash, substrings, tokens
from loglattice.llm.components import connected_components
from tests.llm import plain

# Extra columns with the names that operators use inside.
DOCS = "doc_id bigint, text string, lang string, source string, key string, row string, size int"


def make(spark, texts, sources=None):
    rows = [(i, t, None, (sources or ["s"] * len(texts))[n], "k", "r", 1) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(n, seed):
    draw = random.Random(seed)
    return [f"w{draw.randrange(4000)}" for _ in range(n)]


def test_word_spans_follow_the_pattern():
    texts = ["", "a", " a\tb\x0bc\x1cd ", "é ü ß 😀", "x" * 50]
    buf, offsets = tokens.text_bytes(pa.array(texts))
    starts, ends, doc = tokens.word_spans(buf, offsets, tokens.NOT_SPACE)
    found = [[] for _ in texts]
    for s, e, d in zip(starts, ends, doc, strict=True):
        found[d].append(buf[s:e].tobytes().decode())
    assert found == [plain.spaced(t) for t in texts]


def test_window_hashes_are_equal_for_equal_words_only():
    hasher, roller = tokens.WordHasher(1), tokens.Roller(2)
    buf, offsets = tokens.text_bytes(pa.array(["a b c d", "x a b c", "c b a"]))
    starts, ends, doc = tokens.word_spans(buf, offsets, tokens.NOT_SPACE)
    at, h = tokens.window_hashes(roller, hasher(buf, starts, ends), doc, 3)
    assert at.tolist() == [0, 1, 4, 5, 8]
    assert h[0] == h[3] and len(np.unique(h)) == 4


def test_chunks_take_whole_documents():
    offsets = np.array([0, 5, 5, 30, 31, 60])
    assert list(tokens.chunks(offsets, 10)) == [(0, 2), (2, 3), (3, 4), (4, 5)]


def test_boilerplate_lines(spark):
    menu = "Home About"
    texts = [(i, f"{menu}\nown line {i}\n\n{menu}") for i in range(20)] + [(50, None), (51, ""), (52, "\n")]
    sources = ["a"] * 20 + ["a", None, None]
    out = linededup.drop_boilerplate(make(spark, texts, sources), ratio=0.5, min_pages=5)
    got = {r.row.doc_id: (r.kept, r.n_lines, r.n_dropped) for r in out.collect()}
    assert got[3] == ("own line 3\n", 4, 2)
    assert got[50] == (None, 0, 0) and got[51] == ("", 1, 0) and got[52] == ("\n", 2, 0)


def test_a_common_line_elsewhere_stays_on_its_own_host(spark):
    texts = [(i, "menu\nx" + str(i)) for i in range(10)] + [(100 + i, ("menu" if i == 0 else "") + f"\ny{i}") for i in range(30)]
    out = linededup.drop_boilerplate(make(spark, texts, ["a"] * 10 + ["b"] * 30), ratio=0.5, min_pages=5)
    kept = {r.row.doc_id: r.kept for r in out.collect()}
    assert kept[4] == "x4" and kept[100] == "menu\ny0"


def test_line_dedup_of_an_empty_table(spark):
    assert linededup.drop_boilerplate(make(spark, [(1, "a")]).filter("doc_id < 0")).count() == 0


def test_titles_and_standard_notices_are_labelled(spark):
    program = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the " \
              "Free Software Foundation; either version {} of the License, or (at your option) any later version."
    given = {
        "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991": "gpl-2", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007": "gpl-3",
        program.format("General Public License", "2"): "gpl-2", program.format("General Public License", "3"): "gpl-3",
        program.format("Lesser General Public License", "2.1"): "lgpl", program.format("Affero General Public License", "3"): "agpl-3",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999": "lgpl", "Mozilla Public License Version 2.0": "mpl-2",
        "BSD 3-Clause License": "bsd", "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/": "apache-2",
        "The general public may license version 2 of this in June": None, "a free program by the foundation, version 3": None,
    }
    out = licenses.scan_licenses(make(spark, list(enumerate(given)))).collect()
    found = {r.doc_id: {m.label for m in r.notices} for r in out}
    assert [found[i] for i in range(len(given))] == [{x} if x else set() for x in given.values()]


def test_licence_phrases_and_notices(spark):
    mit = licenses.NOTICES[0][1]
    texts = [
        (1, "Released UNDER the MIT  License. under-the_mit/license"),
        (2, "x " * 3000 + "Apache License, Version 2.0 and CC BY-NC 4.0"),
        (3, None), (4, ""), (5, "the license of mit under apache version 2"),
        (6, mit.replace("to any person", "by Jane Doe to any person") + " mit"), (7, "under the mit licenseé"),
        (8, "mit " * 500), (8, "mit " * 500), (None, "This is licensed under the GNU General Public License, version 3"),
    ]
    rows = licenses.scan_licenses(make(spark, texts)).collect()
    got = sorted((str(r.doc_id), r.n_words, sorted((m.start, m.label) for m in r.phrases)) for r in rows)
    want = sorted((str(i), *plain.licence_places(t, licenses.PHRASES)) for i, t in texts)
    assert got == want
    notices = {r.doc_id: {m.label for m in r.notices} for r in rows}
    assert notices[6] == {"mit"} and notices[None] == {"gpl-3"} and notices[5] == set() and notices[8] == set()


def test_a_notice_without_its_key_phrase_does_not_count(spark):
    text = licenses.NOTICES[0][1].replace("without restriction", "without limits")
    assert licenses.scan_licenses(make(spark, [(1, text)])).first().notices == []


def test_every_template_has_a_rare_word_that_finds_it():
    index = licenses.Index(licenses.templates())
    assert set(index.template.tolist()) == set(range(len(index.items)))


@pytest.fixture(scope="module")
def repeats():
    a, b = prose(300, 1), prose(400, 2)
    rows = [
        (5, " ".join(a)), (2, " ".join(b[:100] + a[50:170] + b[100:])), (9, " ".join(a[100:149])), (1, "short text"),
        (7, "\n ".join(a)), (7, " ".join(b)), (3, None), (4, ""), (6, "loop " * 200), (8, "loop " * 60 + "end"),
        (11, " ".join(prose(70000, 3))), (12, " ".join(prose(70000, 3)[69000:])), (None, " ".join(b)), (None, " ".join(b)),
    ]
    return rows


def test_repeated_windows_go(spark, repeats):
    rows = [tuple(r) for r in substrings.remove_repeats(make(spark, repeats)).collect()]
    assert sorted(rows, key=str) == sorted(plain.without_repeats(repeats, 50), key=str)


def test_repeats_are_found_across_partitions_and_flushes(spark, repeats, monkeypatch):
    monkeypatch.setattr(substrings, "FLUSH_BYTES", 100)
    docs = make(spark, repeats).repartition(7)
    rows = [tuple(r) for r in substrings.remove_repeats(docs, window=20).collect()]
    assert sorted(rows, key=str) == sorted(plain.without_repeats(repeats, 20), key=str)


@pytest.mark.parametrize("flush", [100, 8_000_000])
def test_repeats_among_null_and_repeated_ids(spark, monkeypatch, flush):
    monkeypatch.setattr(substrings, "FLUSH_BYTES", flush)
    draw = random.Random(9)
    passages = [prose(30, 100 + i) for i in range(4)]

    def text(i):
        own, mid = prose(15, i), draw.choice(passages)
        return " ".join(own[:7] + mid[draw.randrange(5) :] + own[7:] + draw.choice([[], mid]))

    rows = [(i, text(i)) for i in range(60)] + [(None, text(1000 + i)) for i in range(1500)] + [(5, text(3000 + i)) for i in range(40)]
    rows += [(None, rows[70][1])] * 300 + [(5, rows[3][1])] * 20 + [(None, None)] * 200 + [(None, "")] * 50 + [(2, None)]
    out = [tuple(r) for r in substrings.remove_repeats(make(spark, rows).repartition(6), window=20).collect()]
    assert sorted(out, key=str) == sorted(plain.without_repeats(rows, 20), key=str)


def test_rows_between_tasks_grow_with_the_table(monkeypatch):
    monkeypatch.setattr(substrings, "FLUSH_BYTES", 20_000)
    counts = []
    for n in (200, 400, 800):
        texts = [" ".join(prose(60, i) + prose(25, 7)) for i in range(n)]
        ids = pa.array(np.arange(n))
        given = [pa.RecordBatch.from_arrays([ids.slice(i, 50), ids.slice(i, 50), pa.array(texts[i : i + 50])], names=["key", "row", "text"])
                 for i in range(0, n, 50)]
        buckets = n // 50
        packs = pa.Table.from_batches(list(substrings._pack(20, buckets)(iter(given))))
        found = [substrings._match(packs.filter(pa.compute.equal(packs["bucket"], b))) for b in range(buckets)]
        counts.append(sum(map(len, found)))
    assert counts[2] < 2.6 * counts[1] < 2.6 * 2.6 * counts[0]


def test_substring_dedup_of_an_empty_table(spark):
    assert substrings.remove_repeats(make(spark, [(1, "a")]).filter("doc_id < 0")).collect() == []


def edited(words, edits, seed):
    draw, out = random.Random(seed), list(words)
    for _ in range(edits):
        out[draw.randrange(len(out))] = f"new{draw.randrange(10**6)}"
    return " ".join(out)


def test_near_duplicates_equal_all_pairs(spark):
    rows = [(i, " ".join(prose(200, i))) for i in range(30)]
    for i in range(30, 150):  # a large group of near copies with similarities on both sides of the threshold
        rows.append((i, edited(prose(200, 3), i % 9, i)))
    rows += [(200 + i, rows[5][1]) for i in range(20)]
    rows += [(300, "a b c"), (301, "a b c"), (302, "a b"), (303, None), (304, ""), (305, " \n")]
    out = minhash.near_duplicates(make(spark, rows).repartition(5)).collect()
    assert {r.doc_id: r.class_id for r in out} == plain.near_duplicates(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in out) and len(out) == len(rows)


def test_near_duplicates_with_null_ids_and_repeated_rows(spark):
    text = " ".join(prose(50, 1))
    out = minhash.near_duplicates(make(spark, [(4, text), (4, text), (None, text), (None, "other words"), (6, "x")])).collect()
    got = sorted((str(r.doc_id), str(r.class_id), r.kept) for r in out)
    # Of the two equal rows one is kept.
    want = [("4", "4", False), ("4", "4", True), ("6", "6", True), ("None", "4", False), ("None", "None", True)]
    assert got == want
    assert minhash.near_duplicates(make(spark, [(1, "a")]).filter("doc_id < 0")).count() == 0


def test_one_row_of_each_class_stays_whatever_the_ids(spark):
    unique = [" ".join(prose(60, i)) for i in range(40)]
    copy, near = " ".join(prose(80, 900)), edited(prose(80, 900), 1, 5)
    rows = [(3, copy), (5, copy), (5, unique[0]), (None, copy), (None, near), (None, unique[1]), (9, unique[2]), (9, unique[2])]
    rows += [(7, unique[i]) for i in range(3, 20)] + [(None, unique[i]) for i in range(20, 40)] + [(None, unique[30])] * 25
    rows += [(8, None), (8, None), (None, ""), (None, "")]
    docs = make(spark, rows).repartition(5)
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    texts = sorted(r.text for r in kept.collect() if r.text)
    assert [t for t in texts if t not in (copy, near)] == sorted(unique) and len(texts) == len(unique) + 1
    assert [r.doc_id for r in kept.collect() if r.text in (copy, near)] == [3]
    out = minhash.near_duplicates(docs).collect()
    assert len(out) == len(rows) and sum(r.kept for r in out) == len(unique) + 1 + 4


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    from loglattice.llm import blocks

    monkeypatch.setattr(blocks.in_blocks, "__defaults__", (8,))
    rows = [(i, edited(prose(120, 3), 4 + i % 5, i)) for i in range(60)]
    out = minhash.near_duplicates(make(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in out} == plain.near_duplicates(rows)


def test_dart_signatures_estimate_weighted_similarity():
    base = prose(400, 9) + ["again"] * 60
    other = base[:330] + prose(60, 10) + ["again"] * 40
    buf, offsets = tokens.text_bytes(pa.array([" ".join(base), " ".join(other), "", "one"]))
    of, elements = minhash.Shingler()(buf, offsets)
    signature = minhash.dart_signatures(of, elements, 4, k=1024)
    want = plain.jaccard(plain.shingles(" ".join(base)), plain.shingles(" ".join(other)))
    assert abs((signature[0] == signature[1]).mean() - want) < 0.06
    assert (signature[2] == 0).all() and (signature[3] != 0).all()


def test_components_of_chains_stars_and_loops(spark):
    draw = random.Random(4)
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(50)] + [(7, 7), (500, 501), (501, 500)]
    draw.shuffle(links)
    out = connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert dict(map(tuple, out.collect())) == plain.groups(nodes, links)
