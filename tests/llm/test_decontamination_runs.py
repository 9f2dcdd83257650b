"""Verification of decontamination hits on their diagonal."""

import numpy as np
import pyarrow as pa

from loanloom.llm import decontamination
from loanloom.llm.tokens import NON_WORD, words


def found(item, doc):
    index = decontamination.SeedIndex.build(["i"], [" ".join(item)])
    return index.overlaps(*words(pa.array([" ".join(doc)], pa.large_string()), NON_WORD)).get((0, 0))


def with_substitutions(item, equal):
    return [w if e else f"other{i}" for i, (w, e) in enumerate(zip(item, equal))]


def test_a_shorter_run_of_larger_gain_hides_no_other():
    item = [f"w{i}" for i in range(40)]
    equal = [False] * 40
    equal[0:7] = [True] * 7
    equal[20:32] = [j not in (4, 8) for j in range(12)]
    assert found(item, with_substitutions(item, equal)) == (12, 10, 20, 20)


def test_a_long_run_of_too_many_substitutions_hides_no_clean_one():
    equal = ([True] * 5 + [False] * 2) * 20 + [True] * 12 + ([False] * 2 + [True] * 5) * 20
    item = [f"w{i}" for i in range(len(equal))]
    n, same, at, _ = found(item, with_substitutions(item, equal))
    assert n >= 12 and same >= 0.75 * n and same == sum(equal[at:at + n])


def test_the_longest_run_equals_its_definition():
    rng = np.random.default_rng(9)
    for _ in range(150):
        n = int(rng.integers(12, 60))
        equal = rng.random(n) < rng.uniform(0.6, 0.9)
        item = [f"w{i}" for i in range(n)]
        index = decontamination.SeedIndex.build(["i"], [" ".join(item)])
        doc = words(pa.array([" ".join(with_substitutions(item, equal))], pa.large_string()), NON_WORD)[0]
        runs = [b - a for a in range(n) for b in range(a + 12, n + 1) if equal[a] and equal[b - 1] and equal[a:b].mean() >= 0.75]
        got = index._verified(doc, 0, 0)
        assert (got[0] if got else 0) == max(runs, default=0)
