"""Decontamination of texts that repeat themselves: work by length, and the same findings as a search over all windows."""

import time

import numpy as np
import pyarrow as pa

from loanloom.llm import decontamination
from loanloom.llm.tokens import NON_WORD, words


def searched(items, docs):
    index = decontamination.SeedIndex.build(list(range(len(items))), [" ".join(x) for x in items])
    return index, index.overlaps(*words(pa.array([" ".join(x) for x in docs], pa.large_string()), NON_WORD))


def test_repetitive_texts_take_time_by_length():
    for period in (1, 2, 7):
        began = time.perf_counter()
        _, found = searched([[f"w{i % period}" for i in range(1000)]], [[f"w{i % period}" for i in range(20_000)]])
        assert found == {(0, 0): (1000, 1000, 0, 0)}
        assert time.perf_counter() - began < 5


def test_differences_of_places():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 200, int(rng.integers(1, 60)))) for _ in range(2))
        assert decontamination._differences(a, b).tolist() == sorted({int(x - y) for x in a for y in b})


def test_findings_equal_a_search_over_all_windows(monkeypatch):
    rng = np.random.default_rng(4)
    for paired in (1 << 16, 4):
        monkeypatch.setattr(decontamination, "PAIRED", paired)
        monkeypatch.setattr(decontamination, "PAIRS_AT_ONCE", 50)
        for _ in range(25):
            kinds = int(rng.integers(1, 5))
            items = [[f"w{x}" for x in rng.integers(0, kinds, int(rng.integers(12, 40)))] for _ in range(3)]
            docs = [[f"w{x}" for x in rng.integers(0, kinds + 1, int(rng.integers(0, 90)))] for _ in range(4)]
            index, found = searched(items, docs)
            want = {}
            codes, first = words(pa.array([" ".join(x) for x in docs], pa.large_string()), NON_WORD)
            for r, doc in enumerate(docs):
                for i, item in enumerate(items):
                    hit = {a - p for a in range(len(doc) - 11) for p in range(len(item) - 11)
                           for mask in decontamination.MASKS if all(doc[a + o] == item[p + o] for o in mask)}
                    runs = [index._verified(codes[first[r]:first[r + 1]], i, d) for d in sorted(hit)]
                    runs = [x for x in runs if x]
                    if runs:
                        want[r, i] = max(runs, key=lambda x: (x[0], x[1], -x[2]))[:3]
            assert {k: v[:3] for k, v in found.items()} == want
