"""Language ID, mixing, pieces, chat, embeddings and top-k search."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loglattice.llm import bitslice, chat, langid, lattice, mixing, pieces, tokens
from tests.llm import plain

DOCS = "doc_id bigint, text string, lang string, source string, row string, score double"


def make(spark, rows):
    return spark.createDataFrame([(*r, "r", 0.5) for r in rows], DOCS)


def sample_texts(n, seed=1):
    draw = random.Random(seed)
    sounds = {"aa": "the of and ing tion er".split(), "bb": "der die und schl keit zu".split(), "cc": "αβ γδ εζ ηθ ικ λμ".split()}
    rows = []
    for i in range(n):
        lang = sorted(sounds)[i % 3]
        rows.append((i, " ".join(draw.choice(sounds[lang]) + draw.choice(sounds[lang]) for _ in range(draw.randint(3, 30))), lang, "s"))
    return rows


def test_language_id_on_held_out_texts(spark):
    docs = make(spark, sample_texts(300))
    model = langid.train(docs, ~langid.held_out())
    out = langid.predict(docs, model).filter(langid.held_out("row.doc_id")).collect()
    assert len(out) > 50 and all(r.row.lang == r.lang_pred and 0 <= r.score <= 1 for r in out)


def test_language_id_equals_plain_naive_bayes(spark):
    texts = sample_texts(90, seed=5) + [(900, "Über étude, naïve! 12", "bb", "s"), (901, "日本語 the", "cc", "s")]
    docs = make(spark, texts)
    model = langid.train(docs, F.lit(True))
    given = [t for _, t, _, _ in texts] + ["the αβ", "zzz", "?", "", None]
    want = plain.bayes([(t, lang) for _, t, lang, _ in texts], given, langid.BUCKETS)
    labels, scores = langid.score_texts(model, pa.array(given))
    assert labels == [x for x, _ in want]
    assert np.allclose(scores, [x for _, x in want], atol=1e-4)


def test_every_language_is_learned(spark):
    rows = [(i, f"{chr(97 + i % 10)}{chr(97 + i // 10 % 10)} " * (5 + i % 7), f"l{i % 100:02d}", "s") for i in range(300)]
    rows += [(1000 + i, "xyz wvu 日本 tsr", "big", "s") for i in range(3000)]
    model = langid.train(make(spark, rows), F.lit(True), docs_per_language=200)
    assert model.labels == sorted({r[2] for r in rows}) and len(model.labels) == 101
    labels, _ = langid.score_texts(model, pa.array([r[1] for r in rows[:100]]))
    assert labels == [r[2] for r in rows[:100]]
    assert model.log_prob.size <= langid.MATRIX_CELLS


def test_undetermined_texts(spark):
    docs = make(spark, sample_texts(60))
    odd = make(spark, [(1, None, "aa", None), (2, "", None, None), (3, "12 !?", None, None), (4, "и", None, None), (None, "the", None, None), (5, "the " * 30000, "bb", None)])
    out = {r.row.doc_id: (r.lang_pred, r.score) for r in langid.predict(odd, langid.train(docs, F.lit(True))).collect()}
    assert [out[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert out[4][0] != "und" and out[None][0] == "aa" and out[5][0] == "aa"


def test_nothing_learned_and_no_rows(spark):
    docs = make(spark, [(1, "abc", None, None)])
    model = langid.train(docs, F.lit(True))
    assert langid.predict(docs, model).first().lang_pred == "und"
    assert langid.predict(docs.filter("doc_id < 0"), model).count() == 0


def test_prediction_ignores_labels_and_order(spark):
    docs = make(spark, sample_texts(60))
    model = langid.train(docs, F.lit(True))
    a = {r.row.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    b = {r.row.doc_id: r.lang_pred for r in langid.predict(docs.withColumn("lang", F.lit("zz")).repartition(5), model).collect()}
    assert a == b


def targets(totals, share=1.5, cap=2.0, weights=(5, 2, 1)):
    """totals: sizes of sources in order; the excess of capped sources is dealt out again and again."""
    w = [weights[i % 3] for i in range(len(totals))]
    out, rest, open_ = [0.0] * len(totals), share * sum(totals), set(range(len(totals)))
    while open_:
        each = {i: rest * w[i] / sum(w[j] for j in open_) for i in open_}
        over = {i for i in open_ if each[i] > cap * totals[i]}
        for i in over or open_:
            out[i] = cap * totals[i] if over else each[i]
        rest -= sum(cap * totals[i] for i in over)
        open_ = open_ - over if over else set()
    return out


@pytest.fixture(scope="module")
def mixture():
    draw = random.Random(2)
    rows = [(i, "w " * draw.choice([0, 1, 5, 20, 200]), None, f"s{i % 7}") for i in range(1500)]
    rows += [(2000 + i, "x y z", None, None) for i in range(40)] + [(3000 + i, "hot " * 10, None, "s0") for i in range(2500)]
    return rows + [(5000, None, None, "s1"), (5001, "", None, "empty"), (None, "a b", None, "s2"), (7, "dup", None, "s1"), (7, "dup", None, "s1")]


def test_mix_meets_targets_and_caps(spark, mixture):
    docs = make(spark, mixture)
    out = mixing.mix_sources(docs).collect()
    assert len(out) == len(mixture)
    names = sorted({r[3] for r in mixture if r[3]}) + [None]
    sizes = {n: sum(len(plain.spaced(r[1])) for r in mixture if r[3] == n) for n in names}
    want = dict(zip(names, targets([sizes[n] for n in names]), strict=True))
    taken = dict.fromkeys(names, 0)
    for r in out:
        assert r.taken == r.copies * r["size"] <= 2 * r["size"] and r.source_size == sizes[r.row.source]
        assert math.isclose(r.target, want[r.row.source], rel_tol=1e-9, abs_tol=1e-6)
        taken[r.row.source] += r.taken
    for n in names:
        assert abs(taken[n] - want[n]) <= 200 + 0.01 * want[n], n


def test_mix_reruns_agree(spark, mixture):
    runs = [
        sorted((str(r.row.doc_id), r["size"], r.taken) for r in mixing.mix_sources(make(spark, mixture).repartition(n)).collect())
        for n in (3, 8)
    ]
    assert runs[0] == runs[1]


def test_rates_are_exponential_in_size_below_the_cap(spark, mixture):
    rows = mixing.mix_sources(make(spark, mixture)).filter("rate < 2 and size > 0").select("row.source", "size", "rate").distinct().collect()
    slopes = {}
    for r in rows:
        slopes.setdefault(r.source, []).append(math.log(float(r.rate)) / r["size"])
    for s in slopes.values():
        assert max(s) - min(s) < 1e-6 * max(1, abs(s[0])) + 1e-8


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_words_taken_come_near_the_targets_of_small_sources(spark, size):
    docs = spark.read.parquet(f"/root/testdata/sf{size}/documents.parquet")
    rows = mixing.mix_sources(docs, carry=["doc_id", "source"]).collect()
    by = {}
    for r in rows:
        by.setdefault(r.row.source, []).append(r)
    assert len(rows) == docs.count() and all(0 <= r.copies <= 2 for r in rows)
    for own in by.values():
        gap = own[0].target - sum(r.taken for r in own)
        free = [r.size for r in own if r.size and (r.copies < 2 if gap > 0 else r.copies > 0)]
        assert abs(gap) < min(free, default=1) or abs(gap) <= 0.02 * own[0].target


def test_mix_with_null_and_repeated_ids(spark):
    draw = random.Random(3)
    rows = [(draw.choice([None, 5, i]), "w " * draw.randrange(1, 60), None, f"s{i % 2}") for i in range(600)]
    rows += [(None, "same text here", None, None)] * 200
    out = mixing.mix_sources(make(spark, rows), carry=["source"]).collect()
    assert len(out) == 800
    for source in ("s0", "s1", None):
        own = [r for r in out if r.row.source == source]
        assert abs(own[0].target - sum(r.taken for r in own)) < 60


def test_mix_of_an_empty_table(spark):
    assert mixing.mix_sources(make(spark, [(1, "a", None, "s")]).filter("doc_id < 0")).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load()


TEXTS = [
    "hello  world\n x", "", "a", "   lead", " trailing  ", "▁marker▁x", "日本語 テキスト 😀😀", "\t\n\r\n", "naïve café ß",
    "x" * 700, "don't   stop", "\x00\x7f", "Ünïcode" * 90,
]


def test_pieces_equal_plain_viterbi(vocabulary):
    draw = random.Random(3)
    texts = TEXTS + ["".join(draw.choice("abe thing \néx") for _ in range(80)) for _ in range(40)]
    buf, offsets = tokens.text_bytes(pa.array(texts))
    ids, count = vocabulary.encode(buf, offsets, tokens.WordHasher(71))
    edge = np.r_[0, np.cumsum(count)]
    assert [ids[edge[i] : edge[i + 1]].tolist() for i in range(len(texts))] == [plain.viterbi(vocabulary, t) for t in texts]


def test_round_trip_and_nulls(spark):
    rows = [(i, t, None, None) for i, t in enumerate(TEXTS)] + [(90, None, None, None), (91, "word " * 40000, None, None), (91, "twice", None, None), (None, "x", None, None)]
    out = pieces.encode_texts(make(spark, rows)).collect()
    assert len(out) == len(rows) and all(r.decoded == r.row.text for r in out)
    by_id = {r.row.doc_id: r for r in out}
    assert by_id[90].ids is None and by_id[1].ids == []
    assert pieces.encode_texts(make(spark, rows).filter("doc_id < 0")).count() == 0


def test_double_array_holds_its_keys_only():
    keys = [b"a", b"ab", b"abc", b"b", b"zz", b"\xff\x00"]
    trie = pieces.DoubleArray(keys)

    def find(word):
        node = 0
        for c in word:
            spot = trie.base[node] + c
            if spot >= len(trie.check) or trie.check[spot] != node:
                return -1
            node = spot
        return int(trie.piece[node])

    assert [find(k) for k in keys] == list(range(len(keys)))
    assert [find(k) for k in (b"z", b"ac", b"abcd", b"\xff")] == [-1] * 4


EVENTS = "conv_id bigint, seq bigint, message bigint, event string, role string, text string"


def told(spark, rows):
    return {
        r.conv_id: [(t.role, t.text) for t in r.turns]
        for r in chat.read_back(chat.render(chat.fold_events(spark.createDataFrame(rows, EVENTS)))).collect()
    }


def test_deltas_edits_and_regenerations_fold(spark):
    rows = [
        (1, 1, 1, "message", "user", "hi"), (1, 2, 2, "message", "assistant", ""), (1, 4, 2, "delta", None, "lo"), (1, 3, 2, "delta", None, "hel"),
        (1, 5, 3, "message", "user", "later"), (1, 6, 2, "regenerate", "assistant", None), (1, 7, 2, "delta", None, "new"),
        (1, 8, 4, "message", "user", "after"), (2, 1, 1, "message", "user", "typo"), (2, 2, 1, "edit", None, "fixed"),
        (None, 1, 1, "delta", None, "x"), (None, 2, 1, "delta", None, None),
    ]
    assert told(spark, rows) == {1: [("user", "hi"), ("assistant", "new"), ("user", "after")], 2: [("user", "fixed")], None: [("", "x")]}


def test_control_strings_survive(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|", "\n<|im_end|>\n", "", "$1 \\ <| |>", "<<|", "é😀" * 3000]
    rows = [(1, i, i, "message", r, t) for i, (r, t) in enumerate(zip(["user", "assistant", "a\nb", "a\\nb", None, "<|x", "assistant", "assistant"], texts, strict=True))]
    assert told(spark, rows)[1] == [(r[4] or "", r[5]) for r in rows]
    out = chat.read_back(chat.render(chat.fold_events(spark.createDataFrame(rows, EVENTS)))).first()
    assert out.loss_texts == [r[5] for r in rows if r[4] == "assistant"]
    assert out.formatted.count(chat.END) == len(rows)


def test_rows_of_one_turn_stay_apart(spark):
    rows = spark.createDataFrame([(1, 0, "user", "b", 1), (1, 0, "user", "a", 2), (1, 0, "user", "a", 2)], "conv_id bigint, turn bigint, role string, text string, seq int")
    out = chat.read_back(chat.render(chat.fold_events(chat.events_of(rows)))).first()
    assert [t.text for t in out.turns] == ["a", "a", "b"]
    assert chat.render(chat.fold_events(chat.events_of(rows.filter("turn > 5")))).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<float>, label int, node int")


def around(seed, n, angle, width=32):
    draw = np.random.default_rng(seed)
    base = draw.standard_normal(width)
    base /= np.linalg.norm(base)
    out = []
    for _ in range(n):
        side = draw.standard_normal(width)
        side -= side @ base * base
        out.append((math.cos(angle) * base + math.sin(angle) * side / np.linalg.norm(side)).tolist())
    return out


def links_of(rows, threshold):
    x = np.array([np.array(v, np.float32).astype(float) for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    return near


def test_embedding_links_equal_all_pairs(spark):
    draw = np.random.default_rng(5)
    spread = [draw.standard_normal(32).tolist() for _ in range(600)]
    close = [v for s in range(40) for v in around(s, 6, 0.1)] + around(77, 150, 0.18)
    rows = list(enumerate(spread + close + [spread[0], spread[0]]))
    odd = [(9000, None), (9001, []), (9002, [0.0] * 32), (9003, [1.0] * 31 + [None]), (9004, [float("nan")] * 32), (9005, [float("inf")] * 32), (9006, [1.0]), (None, spread[0])]
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.near_duplicate_vectors(vectors(spark, rows + odd)).collect()}
    near = links_of(rows, 0.9)
    part = plain.groups(range(len(rows)), np.argwhere(near).tolist())
    assert {i: out[i][:2] for i, _ in rows} == {i: (int(near[i].sum()), part[i]) for i, _ in rows}
    assert all(out[i] == (0, i, i is not None) for i, _ in odd)


def test_recall_of_links_near_the_threshold(spark):
    # Pairs whose cosine is just above 0.9.
    rows, n = [], 400
    for s in range(n):
        draw = np.random.default_rng(1000 + s)
        a, b = draw.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= b @ a * a
        b /= np.linalg.norm(b)
        rows += [(2 * s, a.tolist()), (2 * s + 1, (0.905 * a + math.sqrt(1 - 0.905**2) * b).tolist())]
    out = lattice.near_duplicate_vectors(vectors(spark, rows)).collect()
    assert sum(r.n_links for r in out) / links_of(rows, 0.9).sum() >= 0.97


@pytest.mark.parametrize("n", [800, 1_000_000, 5_000_000, 20_000_000])
def test_pairs_at_the_threshold_meet_at_any_size(n):
    draw = np.random.default_rng(8)
    a, b = draw.standard_normal((2, 2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    hasher = lattice.Hasher(64, n)
    u, v = hasher(a), hasher(0.9 * a + math.sqrt(1 - 0.81) * b)
    assert lattice._met(u, v).any(axis=1).mean() >= 0.985


def test_vectors_of_every_length_and_copies_link(spark):
    draw = np.random.default_rng(15)
    base = around(21, 8, 0.12)
    rows = [(i, v) for i, v in enumerate(base)] + [(100 + i, base[0]) for i in range(50)] + [(200 + i, base[3]) for i in range(9)]
    short = [draw.standard_normal(5).tolist() for _ in range(6)]
    low = [(300 + i, v) for i, v in enumerate(short)] + [(400 + i, short[2]) for i in range(4)]
    out = {r.vec_id: (r.n_links, r.component_id) for r in lattice.near_duplicate_vectors(vectors(spark, rows + low).repartition(4)).collect()}
    for part in (rows, low):
        near = links_of(part, 0.9)
        ids = [i for i, _ in part]
        group = plain.groups(ids, [(ids[a], ids[b]) for a, b in np.argwhere(near)])
        assert {i: out[i] for i in ids} == {i: (int(near[n].sum()), group[i]) for n, i in enumerate(ids)}


def test_rows_of_one_id_share_a_component(spark):
    draw = np.random.default_rng(16)
    a, b = draw.standard_normal((2, 16)).tolist()
    rows = [(5, a), (5, b), (9, b), (3, a), (7, (-np.array(a)).tolist())]
    out = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_duplicate_vectors(vectors(spark, rows)).collect())
    assert out == [(3, 1, 3, True), (5, 1, 3, False), (5, 1, 3, False), (7, 0, 7, True), (9, 1, 3, False)]


def test_equal_vectors_are_one_row_of_every_cell(spark, monkeypatch):
    seen = []
    spread = lattice.in_blocks
    monkeypatch.setattr(lattice, "in_blocks", lambda df, *a: seen.append(df.count()) or spread(df, *a))
    for n in (500, 1000, 2000):
        out = lattice.near_duplicate_vectors(vectors(spark, [(i, [1.0, 2.0]) for i in range(n)])).collect()
        assert all((r.n_links, r.component_id) == (n - 1, 0) for r in out)
    assert len(set(seen)) == 1


def test_embedding_blocks_and_empty_table(spark, monkeypatch):
    from loglattice.llm import blocks

    monkeypatch.setattr(blocks.in_blocks, "__defaults__", (16,))
    rows = list(enumerate(around(3, 90, 0.2)))
    out = {r.vec_id: r.n_links for r in lattice.near_duplicate_vectors(vectors(spark, rows)).collect()}
    assert out == {i: int(n) for i, n in enumerate(links_of(rows, 0.9).sum(axis=1))}
    assert lattice.near_duplicate_vectors(vectors(spark, rows).filter("vec_id < 0")).count() == 0


def test_e8_decoding_is_nearest():
    x = np.random.default_rng(1).normal(size=(300, 8)) * 2
    home = lattice.nearest_e8(x)
    assert len(lattice.shortest_e8()) == 240
    own = ((x - home / 2) ** 2).sum(axis=1)
    for step in lattice.shortest_e8():
        assert (((x - (home + step) / 2) ** 2).sum(axis=1) >= own - 1e-12).all()
    assert (home.sum(axis=1) % 4 == 0).all() and ((home % 2).min(axis=1) == (home % 2).max(axis=1)).all()


def best(rows, asks, k=5):
    usable = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v in rows}
    out = []
    for q in usable:
        if asks(q):
            scores = sorted((-sum(a * b for a, b in zip(usable[q], v, strict=True)), i) for i, v in usable.items() if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("per_block", [8192, 70])
def test_top_k_is_exact(spark, monkeypatch, per_block):
    monkeypatch.setattr(bitslice, "CANDIDATES_PER_BLOCK", per_block)
    monkeypatch.setattr(bitslice, "QUERIES_PER_BLOCK", 3)
    draw = np.random.default_rng(6)
    rows = [(i, (draw.standard_normal(12) / 4).tolist()) for i in range(400)] + [(1000 + i, [0.5] * 12) for i in range(30)] + [(1100, [0.0] * 12)]
    odd = [(2000, None), (2001, []), (2010, [1.0] * 11 + [None]), (2020, [float("nan")] * 12), (2030, [1.0]), (None, [0.1] * 12)]
    out = bitslice.top_k(vectors(spark, rows + odd), F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, out)) == best(rows, lambda i: i % 10 == 0)


def test_top_k_with_few_or_no_candidates(spark):
    rows = [(0, [1.0, -2.0]), (1, [300.0, 5.5]), (2, [-1.0, 0.0])]
    assert sorted(map(tuple, bitslice.top_k(vectors(spark, rows), F.col("vec_id") == 0).collect())) == best(rows, lambda i: i == 0)
    assert bitslice.top_k(vectors(spark, rows).filter("vec_id < 0"), F.lit(True)).count() == 0


def test_top_k_within_every_length_and_refused_sizes(spark):
    rows = [(i, [float(i % 7) - 3, i / 4]) for i in range(40)]
    long = [(100 + i, [float(i % 5), -i / 8, 0.5]) for i in range(30)]
    out = bitslice.top_k(vectors(spark, rows + long), F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, out)) == sorted(best(rows, lambda i: i % 10 == 0) + best(long, lambda i: i % 10 == 0))
    with pytest.raises(ValueError, match="64 bits"):
        bitslice.top_k(vectors(spark, [(0, [1e12, 1.0]), (1, [2.0, 3.0])]), F.lit(True))


def test_adding_slices_is_adding_numbers():
    draw = np.random.default_rng(7)
    a, b = draw.integers(0, 2000, (2, 130))
    ones = np.full((1, 1), np.uint64(2**64 - 1))
    total = [np.zeros((1, 3), np.uint64)]
    bitslice.add_into(total, bitslice.bitmaps(a), 0, ones)
    bitslice.add_into(total, bitslice.bitmaps(b), 3, ones)
    bits = [np.unpackbits(t.view(np.uint8), bitorder="little")[:130].astype(np.int64) << i for i, t in enumerate(total)]
    assert (sum(bits) == a + 8 * b).all()
