"""Quality rules: base counts by loops, trees walked one by one, monotone features, held-out accuracy."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from loanloom.llm import quality_rules as rules
from loanloom.llm.frames import read_table
from loanloom.llm.queries import labels_outside

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines, seen, copies = (text or "").split("\n"), set(), 0
    for line in lines:
        copies += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), copies, len(covered)]


TEXTS = [None, "", " \t\n\v\f\r", "one", "a b c", "a b c a b c", "a a a a", "é x y z#*$%&|<>", "x\n\nx\n \nx \nx\n", "\n\n\n",
         "a b a b a b a b", "tail tail\ntail tail\n" * 30, "w " * 5000]


def test_base_counts_equal_loops(spark):
    draw = random.Random(1)
    texts = TEXTS + [draw.choice([" ", "\n"]).join(draw.choices("abcdé#", k=draw.randint(0, 60))) for _ in range(80)]
    table = spark.createDataFrame([(i, t, 5, "mine") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, kept string")
    judged, names = rules.judge(table, None)
    assert names["n_words"] == "n_words_1" and names["kept"] == "kept_1" and judged.columns[:4] == table.columns
    for r in judged.collect():
        base = brute_base(texts[r["doc_id"]])
        assert [r[names[b]] for b in rules.BASE] == base
        assert r["base_failed"] == (base[0] < 50 or 100 * base[4] > 50 * base[0]) and r["kept_1"] == (not r["base_failed"])
        assert (r["n_words"], r["kept"], r["rule_score"]) == (5, "mine", None)


def test_many_distinct_words_need_no_wide_numbers():
    ids = np.arange(1000) % 700
    assert rules.repeated_words(ids, 700) == rules.repeated_words(ids, 3_000_000)


def walked(model, x):
    total = model.bias
    for node in model.roots:
        while model.left[node] != node:
            node = model.left[node] if x[model.feature[node]] <= model.threshold[node] else model.right[node]
        total += model.value[node]
    return 1 / (1 + np.exp(-total))


@pytest.fixture(scope="module")
def noisy():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(3000, len(rules.FEATURES)))
    up, down = rules.FEATURES.index("lettered_words"), rules.FEATURES.index("symbols")
    # The truth bends against both constraints.
    label = (np.sin(2 * x[:, up]) - np.sin(2 * x[:, down]) + x[:, 0] * x[:, 1] + draw.normal(size=3000) > 0).astype(float)
    return x, label, rules.boost(x, label, np.ones(3000))


def test_flat_arrays_equal_a_walk_of_each_tree(noisy):
    x, label, model = noisy
    assert np.allclose(model.score(x[:200]), [walked(model, r) for r in x[:200]])
    assert ((model.score(x) > 0.5) == label).mean() > 0.75


def test_constrained_features_move_the_score_one_way(noisy):
    x, _, model = noisy
    grid = np.linspace(-4, 4, 81)
    for name, sign in rules.MONOTONE.items():
        rows = np.repeat(x[:50], len(grid), axis=0)
        rows[:, rules.FEATURES.index(name)] = np.tile(grid, 50)
        steps = np.diff(model.score(rows).reshape(50, -1), axis=1)
        assert (sign * steps >= -1e-12).all()
    free = rules.FEATURES.index("log_words")
    rows = np.repeat(x[:50], len(grid), axis=0)
    rows[:, free] = np.tile(grid, 50)
    assert (np.diff(model.score(rows).reshape(50, -1), axis=1) < 0).any()


def test_row_order_does_not_matter(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    one, two = (rules.fit(d, labels_outside(spark, sf, 4, 2)) for d in (docs, docs.repartition(5)))
    assert np.array_equal(one.value, two.value) and np.array_equal(one.threshold, two.threshold)


def test_labels_that_cannot_be_learned_leave_the_base_rules(spark):
    docs = spark.createDataFrame([(1, "a " * 60), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 1)], [(1, None), (None, 0)]):
        assert rules.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int")) is None
    assert rules.judge(docs.limit(0), None)[0].collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = read_table(spark, sf, "documents").select("doc_id", "text"), read_table(spark, sf, "labels")
    judged, _ = rules.judge(docs, rules.fit(docs, labels_outside(spark, sf, 4, 2)))
    held = judged.join(labels, "doc_id").where("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 and not base_failed").collect()
    right = sum(r["kept"] == bool(r["quality"]) for r in held)
    assert len(held) > 50 and right / len(held) > 0.95
