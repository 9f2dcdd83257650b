"""The registered text queries: SQL twins, contracts, and the pipeline against its stages by brute force."""

import hashlib

import pytest
from compare import connect, differences
from test_text_rows import brute_classes

import corpus_pipeline
from loanloom.llm import decontamination, queries
from loanloom.llm.frames import read_table


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_twin(spark, sf, name):
    assert differences(spark, connect(sf), queries.QUERIES[name], queries.ORACLE_SQL[name], sf) == []


@pytest.mark.parametrize("name, columns", [
    ("op2_html_extraction", {"page_id", "url", "text", "n_chars"}),
    ("op5_quality_classifier", {"doc_id", "held_out", "score", "predicted"}),
    ("op7_language_id", {"doc_id", "held_out", "lang_pred", "score"}),
    ("op9_toxicity", {"doc_id", "held_out", "score", "predicted"})])
def test_one_row_for_each_row(spark, sf, name, columns):
    rows = queries.QUERIES[name](spark, sf).collect()
    table = read_table(spark, sf, "pages" if name.startswith("op2") else "documents").collect()
    assert columns <= set(rows[0].asDict()) and sorted(r[0] for r in rows) == sorted(r[0] for r in table)
    for r in rows:
        if "predicted" in columns:
            assert r["predicted"] == int(r["score"] >= (0.7 if name.startswith("op5") else 0.5)) and 0 <= r["score"] <= 1
        if name.startswith("op2"):
            assert r["n_chars"] == len(r["text"])


def test_segmentations_restore_every_text(spark, sf):
    rows = queries.QUERIES["op10_sentencepiece"](spark, sf).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in read_table(spark, sf, "documents").collect()}
    assert all(r["restored"] for r in rows)


def test_pipeline_equals_its_stages_by_brute_force(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
    docs = {r["doc_id"]: r["text"] for r in read_table(spark, sf, "documents").collect() if any(c.isalpha() for c in r["text"] or "")}
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(" \t\n\v\f\r"))
    holders: dict = {}
    for i, t in docs.items():
        for line in t.split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(i)
    gone = {k: max(h) for k, h in holders.items() if len(h) >= 5}
    docs = {i: "\n".join(x for x in t.split("\n") if gone.get(key(x), i) == i) for i, t in docs.items()}
    classes = brute_classes(list(docs.items()))
    docs = {i: t for i, t in docs.items() if classes[i] == i}
    items = [" ".join(r["text"].lower().split()) for r in read_table(spark, sf, "benchmark").collect()]
    held = {i for i, t in docs.items() if any(x in " ".join(t.lower().split()) for x in items)}
    out = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"] for r in out.collect()} == set(docs) - held
    assert out.where("not restored").count() == 0 and "text" not in out.columns
    assert {"doc_id", "lang", "source", "n_chars", "segmentations"} <= set(out.columns)


def test_digest_of_the_kept_text(spark, sf):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op3_line_dedup"](spark, sf).collect()}
    whole = {r["doc_id"]: r["text"] for r in read_table(spark, sf, "documents").collect()}
    assert all(r["kept_sha256"] == hashlib.sha256((whole[i] or "").encode()).hexdigest() for i, r in rows.items() if not r["n_dropped"])


def test_no_benchmark_item_is_left_out_of_the_seeds(spark, sf):
    blocks = list(decontamination.item_blocks(read_table(spark, sf, "benchmark"), block_bytes=500))
    assert sum(len(b.item_ids) for b in blocks) == read_table(spark, sf, "benchmark").count() and len(blocks) > 1
