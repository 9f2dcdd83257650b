"""Documents without a text in the query of sampled segmentations."""

from loanloom.llm import queries


def test_each_document_keeps_a_row(spark, tmp_path):
    rows = [(1, "some words"), (2, None), (3, ""), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op10_sentencepiece"](spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == {1, 2, 3, None}
    for r in got:
        if r["doc_id"] in (2, None):
            assert all(r[c] is None for c in r.asDict() if c != "doc_id")
        else:
            assert r["draw"] >= 1 and r["n_pieces"] >= (r["doc_id"] == 1) and r["restored"] is True
    assert sum(r["doc_id"] is None for r in got) == 1
