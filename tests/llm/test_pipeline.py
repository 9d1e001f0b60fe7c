"""The pipeline's stages against plain Python, each on the rows it is given."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkseries.llm.queries import MIX, MIX_WEIGHTS, mix_levels
from sparkseries.llm.mixing import mixed
from test_groups import roots_of, shingles

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input and the written output of every stage, with odd rows among the documents."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = docs.where("doc_id = 3").first().text
    odd = [(9001, None, "en", "src1", None), (9002, "", None, None, 0), (9003, "12 34 !", "de", "src0", 7),
           (9004, text, None, "src0", len(text)), (9004, text, None, "src0", len(text)), (None, "The and of " * 30, "en", "src2", 5)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(str(base / str(k)))
        out.append(spark.read.parquet(str(base / str(k))))
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stage_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "decontamination", "mixing"]
    assert all(df.columns == COLUMNS for df in stages[:-1]) and stages[-1].columns == [*COLUMNS, "epoch"]


def test_language_stage_keeps_texts_with_letters(stages):
    before, after = stages[0].collect(), stages[1].collect()
    kept = {r.doc_id for r in after}
    assert not kept & {9001, 9002, 9003}
    words = {r.doc_id: len((r.text or "").split()) for r in before}
    assert all(i in kept for i, n in words.items() if n >= 20)
    assert all(r.lang is not None for r in after)


def test_near_copies_leave_one_of_each_group(stages):
    before, after = stages[1].collect(), stages[2].collect()
    sets = {r.doc_id: shingles(r.text, 5) for r in before if r.doc_id is not None}
    edges = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    low = roots_of(sets, edges)
    want = Counter(i for i in sets if low[i] == i)
    assert Counter(r.doc_id for r in after if r.doc_id is not None) == want
    assert any(r.doc_id is None for r in after)


def test_passages_are_cut_from_later_documents(stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    split = lambda t: t.translate(LOWER).split()
    first, repeats = {}, set()
    for i in sorted(k for k in after if k is not None):
        words = split(after[i].text)
        for g in {tuple(words[j:j + 50]) for j in range(len(words) - 49)}:
            if first.setdefault(g, i) != i:
                repeats.add(i)
    assert not repeats
    for i, row in after.items():
        assert row.n_chars == len(row.text) if i is not None else True
        assert len(row.text) <= len(before[i].text)


def test_no_benchmark_windows_are_left(spark, stages):
    words = lambda t: ALNUM.findall((t or "").translate(LOWER))
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    has = lambda t: any(tuple(w[i:i + n]) in windows for w in [words(t)] for n in {len(x) for x in windows} for i in range(len(w) - n + 1))
    before, after = by_id(stages[3]), by_id(stages[4])
    assert set(after) == {i for i, r in before.items() if not has(r.text)}
    assert all(after[i] == before[i] for i in after)


def test_mixture_takes_what_the_operator_says(stages):
    want = mixed(stages[4], mix_levels(), MIX_WEIGHTS, **MIX).collect()
    got = stages[5].collect()
    assert Counter((r.doc_id, r.epoch) for r in got) == Counter((r.doc_id, r.epoch) for r in want)
    before = by_id(stages[4])
    assert all(r.text == before[r.doc_id].text for r in got)


CLASHES = ("score", "lang_pred", "n_words", "hits", "items", "n_hit", "n_items", "contaminated", "_id", "_n", "_cut", "cut", "own_id", "_known", "_base",
           "_row", "_level0", "_order", "_bin", "_edge", "epoch", "kept", "component_id", "place", "count", "c0", "Score_2", "id", "source_doc_id", "key")


def test_columns_of_any_name_keep_their_values(spark, tmp_path):
    """Every stage with columns named like those that operators add or use inside."""
    plain = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    docs = plain.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHES})
    without = plain
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        expected = stage(spark, without, SF)
        last = name == "mixing"
        assert out.columns == docs.columns + (["_epoch"] if last else [])
        out.write.parquet(str(tmp_path / f"a{k}"))
        expected.write.parquet(str(tmp_path / f"b{k}"))
        docs, without = spark.read.parquet(str(tmp_path / f"a{k}")), spark.read.parquet(str(tmp_path / f"b{k}"))
        rows = docs.collect()
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in CLASHES)
        assert Counter((r.doc_id, r.text, r._epoch if last else 0) for r in rows) == Counter((r.doc_id, r.text, r.epoch if last else 0) for r in without.collect())


def test_rows_of_one_id_leave_the_one_with_the_least_text(spark):
    base = "one two three four five six seven eight nine ten " * 3
    rows = [(1, base + "z", "en", "s", 1), (1, "b other text of this id", "en", "s", 2), (1, "a third text of this id", "en", "s", 3), (2, "x y z", "en", "s", 4), (2, None, "en", "s", 5)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
        assert sorted((r.doc_id, r.n_chars) for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()) == [(1, 3), (2, 5)]


def test_texts_longer_than_a_slice_pass_all_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40")
    long = " ".join(r.text for r in docs.where("lang = 'en' and doc_id < 20").collect() if r.text)
    long = (long + "\n") * (2_500_000 // len(long) + 1)
    docs = docs.unionByName(spark.createDataFrame([(777, long, "en", "src1", len(long))], docs.schema))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        found = docs.where("doc_id = 777").select("text").collect()
        if name in ("language_id", "near_dedup"):
            assert [r.text for r in found] == [long]
        if name == "substring_dedup":
            assert not found or len(found[0].text) < len(long) / 10


def test_a_stage_leaves_no_tables_behind_and_an_unset_folder_fails_on_a_cluster(spark):
    import os

    from sparkseries.llm.shared import shared_dir, swept, written

    base = os.path.join(shared_dir(spark), "llm")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    with swept(spark):
        kept = written(corpus_pipeline.near_dedup(spark, spark.read.parquet(f"{SF}/documents.parquet").limit(20), SF), "kept", keep=True)
    assert len(set(os.listdir(base)) - before) == 1 and kept.count() > 0

    class Cluster:
        master = "spark://elsewhere:7077"

    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: default)})
        sparkContext = Cluster

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_subpackage_is_not_imported_elsewhere():
    import pathlib

    root = pathlib.Path(corpus_pipeline.__file__).parent
    files = [p for p in (root / "sparkseries").rglob("*.py") if "llm" not in p.parts]
    assert not [p for p in files if "sparkseries.llm" in p.read_text()]
