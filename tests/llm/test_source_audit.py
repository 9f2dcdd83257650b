"""The divergence audit against exact loops: nulls, empty groups and languages, ties, many segments and blocks."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from loanloom.llm import source_audit

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=3, top=200):
    docs = [(lang or "", source or "", [re.sub("[A-Z]+", lambda m: m[0].lower(), w) for w in TERM.findall(text or "")]) for text, lang, source in rows]
    out = []
    share = lambda c, n, v: 1 + 10 ** 9 * (c + 1) // (n + v)
    for lang in {d[0] for d in docs}:
        held = Counter(w for a, _, ws in docs if a == lang for w in set(ws))
        kept = sorted(w for w, n in held.items() if n >= least)
        v = len(kept)
        groups = {s: Counter(w for a, b, ws in docs if (a, b) == (lang, s) for w in ws if held[w] >= least) for a, s, _ in docs if a == lang}
        whole = sum(groups.values(), Counter())
        p = {s: {w: share(c[w], sum(c.values()), v) for w in kept} for s, c in groups.items()}
        q = {w: share(whole[w], sum(whole.values()), v) for w in kept}
        for s in groups:
            pairs = [(t, sum((p[s][w] - p[t][w]) ** 2 // p[t][w] for w in kept)) for t in groups if t != s]
            terms = [(w, (p[s][w] - q[w]) ** 2 // q[w]) for w in kept if groups[s][w] and p[s][w] > q[w]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items[:limit])]
    return sorted(out)


def audited(spark, rows, **how):
    table = spark.createDataFrame([(i, *r, "x", 1) for i, r in enumerate(rows)], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in source_audit.audit(table, **how).collect())


def corpus(seed):
    draw = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "élan", "Élan", "naïve", "中文", "it's", "x1y", "", "zz top", "omega"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for _ in range(160):
        lang, source = draw.choice(["en", "en", "en", "fr", None]), draw.choice(["a", "a", "a", "b", "c", "d", "é", None])
        text = draw.choice([" ", "\n", "\t", "_"]).join(draw.choices(words, k=draw.randint(0, 40))) if draw.random() > 0.05 else None
        rows.append((text, lang, source))
    return rows + [(None, "xx", "only"), ("", "yy", "p"), ("rare words here", "yy", "q"), ("...", "en", "empty")] + rows[:20]


@pytest.mark.parametrize("how", [{}, {"segment_terms": 3, "block_sources": 2}, {"segment_terms": 1, "block_sources": 1}])
def test_equals_exact_loops(spark, how):
    rows = corpus(4)
    assert audited(spark, rows, **how) == brute(rows)


def test_ranks_end_at_the_top_and_ties_follow_the_bytes(spark):
    rows = corpus(9)
    assert audited(spark, rows, top=2, least=1) == brute(rows, least=1, top=2)


def test_no_rows_and_a_very_long_text(spark):
    assert audited(spark, []) == []
    rows = [("word " * 300_000 + "tail", "en", "a"), ("word tail", "en", "b"), ("tail word word", "en", "c"), ("x" * 2_000_000, "en", "c")]
    assert audited(spark, rows) == brute(rows)


def test_gallop_finds_the_first_place_not_less():
    draw = np.random.default_rng(3)
    for n, m in ((0, 5), (5, 0), (1, 1), (40, 1000), (1000, 40), (333, 333)):
        needles, hay = np.sort(draw.integers(0, 500, n)), np.sort(draw.integers(0, 500, m))
        assert (source_audit.gallop(needles, hay) == np.searchsorted(hay, needles)).all()


def test_shares_are_exact_for_large_counts():
    for count, total in ((10 ** 12, 10 ** 13 + 7), (0, 9 * 10 ** 15), (10 ** 15 - 1, 10 ** 15), (5, 7)):
        assert int(source_audit.shares(count, total)) == 1 + 10 ** 9 * (count + 1) // total
