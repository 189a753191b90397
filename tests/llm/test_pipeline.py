"""Stages of the pipeline on odd rows."""

import corpus_pipeline
import pytest

TEXT = "one two three four five six seven eight nine ten eleven twelve"
ROWS = [
    (1, TEXT), (1, TEXT), (2, TEXT + " thirteen"), (1, "quite another text under the same number that must stay as it is"), (3, None), (3, None),
    (None, TEXT), (4, ""), (5, "short"), (6, TEXT.upper()),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row_doc string, row_text string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", None, 0.5, "a", "b") for d, t in rows], SCHEMA).repartition(3)


def test_near_duplicates_go_by_row(spark, sf_dir):
    got = corpus_pipeline.drop_near_duplicates(spark, frame(spark, ROWS), sf_dir)
    assert got.columns == frame(spark, ROWS).columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    want = [(1, TEXT), ROWS[3], (3, None), (3, None), (None, TEXT), (4, ""), (5, "short")]
    assert kept == sorted(want, key=repr)


@pytest.mark.parametrize("rows", [ROWS, []])
def test_all_stages_take_odd_rows(spark, sf_dir, rows):
    docs = frame(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert name == "bpe" or out.columns == docs.columns
        kept = out.collect()
        assert len(kept) <= len(rows)
        docs = out if name == "bpe" else spark.createDataFrame(kept, docs.schema)
    if rows:
        assert {"doc_id", "n_tokens", "ids_sha256"} <= set(docs.columns)
        # the common line stays in document 6 only, which then is a near copy of document 2
        assert sorted((r.doc_id for r in docs.collect()), key=repr) == sorted([1, 1, 1, 2, 3, 3, 4, 5, None], key=repr)


def test_texts_travel_in_small_batches(spark, sf_dir):
    import pyarrow as pa

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    try:
        corpus_pipeline.STAGES[1][1](spark, frame(spark, ROWS), sf_dir)

        def sizes(batches):
            yield from (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches)

        got = [r.n for r in spark.range(0, 3000, 1, 1).mapInArrow(sizes, "n long").collect()]
        assert sum(got) == 3000 and max(got) <= corpus_pipeline.BATCH_ROWS
        spark.conf.set(key, "100")  # a smaller limit stays
        corpus_pipeline.STAGES[1][1](spark, frame(spark, ROWS), sf_dir)
        assert spark.conf.get(key) == "100"
    finally:
        spark.conf.set(key, old)
