"""The stages of the corpus pipeline lose no text of their own."""

from pyspark.sql import functions as F

import corpus_pipeline
from millrace.sources.tables import table
from tests.llm.cases import SCHEMA, documents, frame, sentence


def kept_of(spark, rows):
    return sorted(((r.doc_id, r.text, r.row) for r in corpus_pipeline.near_duplicates(spark, frame(spark, rows), "").collect()), key=repr)


def test_different_texts_of_one_id_stay(spark):
    """Id 21 repeats a text of id 1, has a text twice and one of its own; id 22 two similar texts."""
    tail = ("k", 1, 2, 3, 4, 0, "s")
    base, own, other = sentence(1, 200), sentence(50, 90), sentence(51, 90)
    more = [(21, base, *tail), (21, own, *tail), (21, own, *tail), (21, other, *tail), (22, sentence(52, 200), *tail), (22, sentence(52, 200) + " more", *tail)]
    got = kept_of(spark, documents() + more)
    texts = [(k, t) for k, t, _ in got]
    assert [t for k, t in texts if k == 21] == sorted([own, other], key=repr)
    assert len([t for k, t in texts if k == 22]) == 1
    assert sorted(t for k, t in texts if k == 15) == sorted([sentence(5, 90), sentence(6, 90)])
    assert [k for k, t in texts if t == base] == [1, None] and [k for k, t in texts if t == sentence(3, 6000)] == [11]
    assert {k for k, _ in texts} == {1, 4, 5, 6, 7, 10, 11, None, 12, 13, 14, 15, 21, 22}  # 8 has the words of 7


def test_the_kept_row_does_not_depend_on_the_order(spark):
    rows = [(1, sentence(1, 60), "k", i, 2, 3, 4, 0, "s") for i in range(20)]
    assert kept_of(spark, rows) == kept_of(spark, rows[::-1]) and len(kept_of(spark, rows)) == 1
    assert corpus_pipeline.near_duplicates(spark, spark.createDataFrame([], SCHEMA), "").count() == 0


def awkward(spark, sf):
    """Documents of the table and awkward ones, with columns that operators name alike."""
    given = table(spark, sf, "documents")
    extra = spark.createDataFrame([(i, t, None, "s", None) for i, t, *_ in documents()], given.schema)
    return given.union(extra).withColumns({c: F.lit(1) for c in ("key", "row", "score", "bucket", "others", "start", "component_id")})


def test_stages_keep_the_columns_and_take_awkward_rows(spark, sf):
    docs = awkward(spark, sf)
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.repeated_passages):
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns and [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
        assert kept.where("text is null").count() >= 1
    kept = corpus_pipeline.quality(spark, docs.drop("score"), sf)
    assert kept.columns == docs.drop("score").columns and 0 < kept.count() <= docs.count()
    pieces = corpus_pipeline.packing(spark, docs, sf)
    assert pieces.agg(F.sum("length")).first()[0] == pieces.where("start = 0").agg(F.sum("doc_tokens")).first()[0]


def test_stages_take_empty_tables(spark, sf, tmp_path):
    none = table(spark, sf, "documents").where("false")
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.repeated_passages, corpus_pipeline.packing):
        assert stage(spark, none, sf).count() == 0
    assert corpus_pipeline.quality(spark, none, sf).count() == 0
