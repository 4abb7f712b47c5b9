from collections import Counter

import pytest
from frames import awkward_rows, documents, empty, labels, prose
from pyspark.sql import functions as F

import corpus_pipeline
from stockloom.llm import decontamination, near_dedup, quality
from stockloom.plans.joins import settled


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    rows = awkward_rows()
    leak = prose(30, 555, 2000)
    for i in range(100, 220):
        text = prose(60 + i % 50, i // 2 if i % 10 < 2 else i, 300)  # some equal texts
        if i % 25 == 0:
            text = f"{text} {leak}"
        if i % 20 == 5:
            text = text.upper().replace(" ", "!! ")
        rows.append((i, text, "en", f"s{i % 4}"))
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    labels(spark, [(i, int(i % 20 != 5), 0) for i in range(100, 220) if i % 3]).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def _read(spark, folder, name="documents"):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _count(df):
    return Counter((r.doc_id, r.text, r.lang, r.source) for r in df.collect())


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "sharding"]


def test_each_stage_does_what_its_operator_decides(spark, folder):
    docs = _read(spark, folder)
    good = corpus_pipeline.quality_stage(spark, docs, folder)
    assert good.columns == docs.columns
    good = settled(good, "t")
    verdict = quality.judge(docs, _read(spark, folder, "labels")).filter("kept")
    assert Counter(r.doc_id for r in good.collect()) == Counter(r.doc_id for r in verdict.collect())
    assert not any("!!" in r.text and r.text.isupper() for r in good.collect())

    single = settled(corpus_pipeline.near_dedup_stage(spark, good, folder), "t")
    classes = near_dedup.near_duplicates(good)
    assert single.columns == docs.columns and single.count() == classes.select("class_id").distinct().count()
    assert _count(single) <= _count(good) and max(_count(single).values()) == 1

    clean = settled(corpus_pipeline.decontamination_stage(spark, single, folder), "t")
    leaks = decontamination.find_items(single, _read(spark, folder, "benchmark")).select("doc_id").distinct()
    assert clean.columns == docs.columns and leaks.count() > 0
    assert Counter(r.doc_id for r in clean.collect()) == Counter(
        r.doc_id for r in single.join(leaks, "doc_id", "left_anti").collect()
    )

    mixed = settled(corpus_pipeline.mixing_stage(spark, clean, folder), "t")
    assert mixed.columns == docs.columns and set(_count(mixed)) <= set(_count(clean))
    assert set(_count(mixed).values()) <= {1, 2}
    sized = sum(len(t.split()) * n for (_, t, _, _), n in _count(mixed).items())
    assert sized == pytest.approx(1.5 * sum(len(r.text.split()) for r in clean.collect()), rel=0.05)

    placed = corpus_pipeline.sharding_stage(spark, mixed, folder).collect()
    assert Counter(r.doc_id for r in placed) == Counter(r.doc_id for r in mixed.collect())


def test_rows_without_a_proper_id_are_told_apart(spark, folder):
    rows = [(None, prose(50, 1), "en", "a"), (None, prose(50, 2), "en", "a"), (5, prose(50, 3), "en", "a"), (5, prose(50, 4), "en", "a")]
    got = corpus_pipeline.near_dedup_stage(spark, documents(spark, [*rows, rows[0]]), folder)
    assert _count(got) == Counter({(i, t, lang, s): 1 for i, t, lang, s in rows})


def test_columns_called_like_the_helpers(spark, folder):
    docs = _read(spark, folder)
    names = ("_pipeline_row", "__Pipeline_Row", "_times", "class_id", "count", "quality", "a.b", "t", "s", "none")
    docs = docs.select("*", *(F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = settled(stage(spark, docs, folder), "t")
        assert got.columns == docs.columns and 0 < got.count() <= 2 * docs.count(), name
        for n in names:
            assert got.filter(~F.col(f"`{n}`").eqNullSafe(F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")))).isEmpty()
        docs = got
    assert corpus_pipeline.sharding_stage(spark, docs, folder).count() == docs.count()


def test_no_documents(spark, folder):
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, folder), "t")
        assert docs.count() == 0


def test_whole_run(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.count() > 100 and got.select(F.max("shard")).first()[0] < 40
