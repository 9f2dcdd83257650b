"""Large groups of near copies, many pairs of which are below the bound, against all pairs by brute force."""

import random

import numpy as np
import pytest

from loanloom.llm import near_duplicates as near


def brute_classes(rows):
    """Components over all pairs; of each pair the common weight is counted, and the similarity taken where that allows it."""
    bags = [near.bag(t) for _, t in rows]
    place = {c: i for i, c in enumerate({c for codes, _ in bags for c in codes.tolist()})}
    weight = np.zeros((len(rows), len(place)), np.float32)
    for i, (codes, w) in enumerate(bags):
        weight[i, [place[c] for c in codes.tolist()]] = w
    inside = weight @ (weight > 0).T.astype(np.float32) / weight.sum(axis=1)[:, None]
    label = {i: i for i, _ in rows}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in zip(*np.nonzero(np.triu((inside >= 0.799) & (inside.T >= 0.799), 1))):
        x, y = find(rows[a][0]), find(rows[b][0])
        if x != y and near.probability_jaccard(bags[a], bags[b]) >= near.SIMILARITY:
            label[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def edited(draw, words, edits, vocabulary):
    out = list(words)
    for _ in range(edits):
        out[draw.randrange(len(out))] = draw.choice(vocabulary)
    return " ".join(out)


def group(seed, size, with_base, repeats=0):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(5000)}" for _ in range(110)]
    for r in range(repeats):    # shingles that occur twice
        base[40 + 10 * r:46 + 10 * r] = base[:6]
    common = [f"c{i}" for i in range(6)]      # replacements that copies share
    rows = [" ".join(base)] if with_base else []
    while len(rows) < size:
        cut = base[:draw.choice([110, 110, 110, 104, 96])]
        rows.append(edited(draw, cut, draw.choice([0, 1, 2, 3, 4, 5]), common if draw.random() < 0.7 else [f"r{draw.random()}"]))
    return rows


@pytest.mark.parametrize("seed, size, with_base, repeats", [(1, 2000, True, 0), (2, 300, False, 2)])
def test_classes_of_a_large_group(spark, seed, size, with_base, repeats):
    rows = list(enumerate(group(seed, size, with_base, repeats) + [f"other text number {i} with a few words of its own {i * 7}" for i in range(40)]))
    random.Random(seed).shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = {r["doc_id"]: r["class_id"] for r in near.classes(table).collect()}
    expected = brute_classes(rows)
    assert found == expected
    assert len(set(expected.values())) > 45      # many pairs of the group are below the bound


def test_repetitive_texts_of_any_length_meet(spark):
    once = " ".join(f"a{i}" for i in range(60))
    rows = [(1, once + " " + once), (2, " ".join([once] * 5)), (3, once), (4, once + " tail"), (5, "x y z " * 400), (6, "x y z " * 20), (7, once + " " + once + " more")]
    found = {r["doc_id"]: r["class_id"] for r in near.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute_classes(rows)


def similar(a, b):
    return near.probability_jaccard(near.bag(a), near.bag(b))


def test_allowances_lose_no_pair():
    """Any pair at the bound shares one of the shingles that both post, in any order of the shingles."""
    draw, found = random.Random(5), 0
    for _ in range(1200):
        base = [f"w{draw.randrange(60)}" for _ in range(draw.choice([30, 60]))]
        if draw.random() < 0.5:
            base[20:28] = base[:8]
        x = edited(draw, base[:draw.choice([len(base), len(base) - 3])], draw.randrange(3), ["p", "q"])
        y = edited(draw, base, draw.randrange(3), ["p", "q"])
        if similar(x, y) < near.SIMILARITY:
            continue
        found += 1
        bags = [near.bag(t) for t in (x, y)]
        sizes = [int(w.sum()) for _, w in bags]
        repeats = [int((w - 1).sum()) for _, w in bags]
        classes = [(int(near.size_class(s)), int(near.repeated_class(np.array([s]), np.array([r]))[0])) for s, r in zip(sizes, repeats)]
        heavy = any(k == -1 for _, k in classes)
        first = {c for c in set(bags[0][0].tolist()) & set(bags[1][0].tolist())}
        order = sorted(set(bags[0][0].tolist()) | set(bags[1][0].tolist()), key=lambda c: draw.random())
        first = next(c for c in order if c in first)
        for own, other in ((0, 1), (1, 0)):
            # Everything is shared with somebody, so the list is the whole text.
            weights = dict(zip(*[v.tolist() for v in bags[own]]))
            before = 0
            for c in order:
                if c == first:
                    break
                before += weights.get(c, 0)
            allowed = near.allowances(sizes[own], sizes[own], repeats[own], [classes[other]])
            wanted = (0, -1) if heavy else classes[other]
            assert any((s, k) == wanted and before <= weight + 1e-6 for s, k, weight in allowed)
    assert found > 100
