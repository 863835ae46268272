"""The pipeline against a brute-force version on a small corpus."""

import random

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(8)
    word = lambda: rng.choice(["stone", "river", "light", "ember", "field"]) + str(rng.randrange(300))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(40)
    base = text(120)
    docs = [(i, text(rng.randrange(60, 150))) for i in range(30)]
    docs += [(100, base), (101, base), (102, base + " more"), (103, "too short"), (104, None), (105, "a b c " * 60), (106, text(50) + " " + passage), (107, text(80) + " password=hunter2hunter2 " + text(10))]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(i, t, "en", f"src{i % 2}", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), docs, [(1, passage)]


def test_pipeline(spark, corpus):
    folder, docs, items = corpus
    left = [(i, t) for i, t in docs if not brute.quality(t)[5]]
    comp = brute.components(left, 5, 80)
    left = [(i, t) for i, t in left if comp[i][1] == i]
    bad = brute.decontaminate(left, items)
    left = {i for i, t in left if not bad[i][4]}
    assert left == {*range(30), 100, 107}
    rows = cp.run(spark, folder).collect()
    assert {r.doc_id for r in rows} == left
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        assert sum(n for _, n in parts) <= 2048 and sorted(parts)[0][0] == 0


def test_stages_keep_the_columns(spark, corpus):
    folder, _, _ = corpus
    df = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, df, folder)
        assert out.columns == df.columns
        path = f"{folder}/stage-{stage.__name__}"
        out.write.parquet(path)
        df = spark.read.parquet(path)
    texts = [r.text for r in df.collect()]
    assert not any(brute.secrets(t) for t in texts)


def test_null_and_repeated_ids_are_judged_row_by_row(spark, tmp_path):
    rng = random.Random(21)
    text = lambda n: " ".join(rng.choice(["stone", "river", "light", "ember"]) + str(rng.randrange(300)) for _ in range(n))
    passage, base = text(40), text(120)
    clean = [text(90) for _ in range(7)]
    docs = [(None, "too short"), (None, clean[0]), (None, clean[1]), (5, "too short"), (5, clean[2]), (5, clean[3]), (5, clean[3]), (6, clean[4]), (6, clean[4])]
    docs += [(None, text(50) + " " + passage), (None, base), (None, base), (None, base + " more"), (7, base), (8, text(50) + " " + passage), (8, clean[5]), (None, clean[6]), (None, clean[6] + " more")]
    spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in cp.STAGES[:3]:
        stage(spark, df, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
    got = sorted((r.doc_id or 0, r.text) for r in df.collect())
    assert {t for _, t in got if t.startswith(clean[6])} < {clean[6], clean[6] + " more"}
    want = [(0, clean[0]), (0, clean[1]), (5, clean[2]), (5, clean[3]), (6, clean[4]), (7, base), (8, clean[5])]
    assert [g for g in got if not g[1].startswith(clean[6])] == sorted(want) and len(got) == len(want) + 1


def test_rows_without_words_link_with_nothing(spark):
    rows = [(None, None), (None, None), (1, ""), (1, ""), (2, "..."), (3, "some words"), (3, "some words")]
    docs = spark.createDataFrame([(i, t, "src") for i, t in rows], "doc_id long, text string, source string")
    got = [(r.doc_id, r.text) for r in cp.keep_one_of_each(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted(rows[:-1], key=str)


def test_stages_of_empty_and_clashing_tables(spark, tmp_path):
    """No rows in, none out; columns with names that the operators use go through every stage unharmed."""
    rng = random.Random(2)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    names = ["set", "half", "n", "_id", "_text", "_key", "_row", "kept", "host", "label", "items", "spans", "size"]
    rows = [(i, text(n), f"s{i % 2}") for i, n in enumerate((60, 70, 30_000, 80))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for k, c in enumerate(names):
        docs = docs.withColumn(c, F.lit(str(k)))
    spark.createDataFrame([(1, text(20))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert sorted(out.collect()) == sorted(docs.collect()), name
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0
    assert cp.STAGES[-1][1](spark, docs.where("false"), str(tmp_path)).count() == 0
