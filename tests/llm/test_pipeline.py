from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from texts import frame, odd_rows, prose

from tillback.llm.queries import QUERIES, STATEMENTS


def tables(spark, tmp_path):
    rows = [(k, prose(k, 80)) for k in range(40)] + [(100 + k, prose(3, 80)) for k in range(5)]
    rows += [(200, prose(9, 80) + " tail"), (201, "mail me at a.b@mail.example.org " + prose(201, 60))]
    docs = frame(spark, rows).withColumn("n_chars", F.length("text").cast("bigint"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return docs


def test_stages(spark, tmp_path):
    docs = tables(spark, tmp_path)
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns, name
    kept = {r.doc_id: r for r in current.collect()}
    assert set(kept) == {*range(40), 201}
    assert "[EMAIL]" in kept[201].text and kept[201].n_chars == len(kept[201].text)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == set(kept)


def test_stages_on_odd_and_empty_rows(spark, tmp_path, odd, empty):
    tables(spark, tmp_path)
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, odd, str(tmp_path)).collect()
        assert result or not odd_rows(), name
        assert stage(spark, empty, str(tmp_path)).collect() == [], name
    toxic = corpus_pipeline.STAGES[0][1](spark, odd, str(tmp_path))
    assert Counter((r.doc_id, r.text) for r in toxic.collect()) == Counter(odd_rows())


def test_queries_are_named_by_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(STATEMENTS) <= set(QUERIES)


def test_no_text_is_lost_where_ids_repeat(spark, tmp_path):
    a, b = prose(301, 70), prose(302, 70)
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = frame(spark, [(3, a), (7, a), (7, b), (9, b), (None, prose(303, 70))])
    kept = corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(3, a), (7, b), (None, prose(303, 70))])
    lines = corpus_pipeline.line_dedup(spark, docs, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.text) for r in lines) == Counter([(None, prose(303, 70)), (3, a), (7, b)])
