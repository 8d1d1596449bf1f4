"""The pipeline's stages on a small table, each against a plain version of what it should keep."""

import random

import corpus_pipeline as P
import pytest

from loglattice.llm import pieces
from tests.llm import plain

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage returned, the given documents first."""
    draw = random.Random(8)
    words = {"aa": "the of and ing tion er sh".split(), "bb": "der die und schl keit zu be".split()}

    def text(lang, n):
        return " ".join(draw.choice(words[lang]) + draw.choice(words[lang]) + draw.choice(words[lang]) for _ in range(n))

    rows = []
    for i in range(240):
        lang = "aa" if i % 3 else "bb"
        rows.append((i, f"menu of the site\n{text(lang, 60)}\n{text(lang, 40)}", lang, f"s{i % 4}"))
    copies = [(300 + i, rows[5][1] if i % 2 else rows[5][1].replace("menu", "", 1), "aa", f"s{i % 4}") for i in range(30)]
    odd = [(400, None, "aa", "s0"), (401, "", None, "s1"), (402, "12 34 !!", "aa", None), (403, text("aa", 50), None, None)]
    rows = [(*r, len(r[1] or "")) for r in rows + copies + odd]
    base = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{base}/documents.parquet")
    docs = spark.read.parquet(f"{base}/documents.parquet")
    seen = [docs]
    for name, stage in P.STAGES:
        stage(spark, docs, str(base)).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        seen.append(docs)
    return {"base": base, "frames": seen, "rows": [{r.doc_id: r for r in f.collect()} for f in seen]}


def test_stages_return_documents(steps):
    assert [name for name, _ in P.STAGES] == ["language_id", "line_dedup", "minhash_near_dedup", "mix_sources", "sentencepiece"]
    assert all(f.columns == steps["frames"][0].columns for f in steps["frames"][:-1])


def test_language_id_rejects_texts_without_letters_only(steps):
    given, kept = steps["rows"][0], steps["rows"][1]
    assert set(given) - set(kept) == {400, 401, 402}
    assert all(kept[i] == given[i] for i in kept)


def test_line_dedup_takes_the_menu_out(steps):
    before, after = steps["rows"][1], steps["rows"][2]
    assert set(before) == set(after)
    for i, r in after.items():
        want = "\n".join(x for x in before[i].text.split("\n") if x != "menu of the site")
        # The copies share their other lines, which are boilerplate only above the ratio.
        if i < 300 and i != 5:
            assert r.text == want and r.n_chars == len(want)


def test_line_dedup_goes_by_share_on_small_hosts_too(spark):
    rows = [(i, f"menu\nline {i}", "aa", "small" if i < 5 else "large", 1) for i in range(65)]
    rows += [(100, "alone\nmenu", "aa", "single", 1), (101, "seen twice", "aa", "large", 1), (102, "seen twice", "aa", "large", 1)]
    out = {r.doc_id: r.text for r in P.line_dedup(spark, spark.createDataFrame(rows, COLUMNS), "").collect()}
    assert all(out[i] == f"line {i}" for i in range(65))
    assert out[100] == "alone\nmenu" and out[101] == out[102] == "seen twice"


def test_near_dedup_keeps_one_of_each_group(steps):
    before, after = steps["rows"][2], steps["rows"][3]
    classes = plain.near_duplicates([(i, r.text) for i, r in before.items()])
    assert set(after) == {i for i, c in classes.items() if i == c}
    assert all(after[i] == before[i] for i in after)


def test_mixing_repeats_documents_towards_the_targets(spark, steps):
    before, after = steps["rows"][3], steps["frames"][4].collect()
    sizes = {}
    for r in before.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(plain.spaced(r.text))
    taken = dict.fromkeys(sizes, 0)
    for r in after:
        assert r == before[r.doc_id]
        taken[r.source] += len(plain.spaced(r.text))
    assert 1.3 < sum(taken.values()) / sum(sizes.values()) < 1.7
    assert all(taken[s] <= 2 * sizes[s] for s in sizes)


def test_pieces_spell_the_texts(steps):
    texts = {i: r.text for i, r in steps["rows"][3].items()}
    vocabulary = pieces.Vocabulary.load()
    for r in steps["frames"][5].collect():
        assert b"".join(vocabulary.pieces[i] for i in r.ids)[1:].decode() == texts[r.doc_id]
        assert r.n_pieces == len(r.ids)
    some = list(steps["rows"][5].values())[:5]
    assert all(r.ids == plain.viterbi(vocabulary, texts[r.doc_id]) for r in some)


def test_run_gives_the_rows_of_the_stages(spark, steps):
    ran = P.run(spark, str(steps["base"])).collect()
    assert sorted((r.doc_id, len(r.ids)) for r in ran) == sorted((r.doc_id, len(r.ids)) for r in steps["frames"][5].collect())
