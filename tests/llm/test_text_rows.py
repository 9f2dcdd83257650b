"""Line dedup, near-duplicates, decontamination and language ID on small tables and against brute force."""

import collections
import hashlib

import numpy as np
import pytest

from loanloom.llm import decontamination, language, line_dedup, near_duplicates
from loanloom.llm.components import connected_components
from loanloom.llm.frames import bucket_of, read_table
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, keys string, `high.x` int"
LONG = "this line is long enough to count as a key of forty characters"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "k", 1) for i, t in rows], SCHEMA)


def test_lines_stay_in_the_largest_document_only(spark):
    rows = [(i, f"own line {i}\n  {LONG.upper() if i % 2 else LONG}\t\n{LONG}") for i in range(6)]
    rows += [(20, "x" * 39), (21, None), (22, ""), (None, LONG), (None, LONG), (5, f"again\n{LONG}"), (0, f"{LONG}\nother")]
    out, added = line_dedup.without_repeated_lines(table(spark, rows))
    assert out.columns == ["doc_id", "text", "lang", "keys", "high.x", "n_lines", "n_dropped"]
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "", r["n_lines"], r["n_dropped"]) for r in out.collect())
    assert (0, "own line 0", 3, 2) in got and (0, "other", 2, 1) in got
    assert (5, f"own line 5\n  {LONG.upper()}\t\n{LONG}", 3, 0) in got and (5, f"again\n{LONG}", 2, 0) in got
    assert got.count((-1, LONG, 1, 0)) == 2 and (21, "", 1, 0) in got and (22, "", 1, 0) in got
    assert len(got) == len(rows)


def test_lines_of_four_documents_stay(spark):
    out, _ = line_dedup.without_repeated_lines(table(spark, [(i, LONG) for i in range(4)]))
    assert out.agg(F.sum("n_dropped")).first()[0] == 0
    short = "é" * 39
    out, _ = line_dedup.without_repeated_lines(table(spark, [(i, short) for i in range(9)] + [(100 + i, "É" * 40) for i in range(9)]))
    assert out.agg(F.sum("n_dropped")).first()[0] == 8
    assert line_dedup.without_repeated_lines(table(spark, []))[0].count() == 0


def test_filters_find_every_repeat_when_folded(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "PROBE_BYTES", 1 << 18)
    monkeypatch.setattr(line_dedup, "BITS_PER_KEY", 1 << 12)
    rows = [(i, "\n".join(f"{LONG} {(i * 7 + j) % 40}" for j in range(5))) for i in range(60)]
    out, _ = line_dedup.without_repeated_lines(table(spark, rows))
    holders = collections.defaultdict(set)
    for i, t in rows:
        for x in t.split("\n"):
            holders[x].add(i)
    want = {i: [x for x in t.split("\n") if len(holders[x]) < 5 or i == max(holders[x])] for i, t in rows}
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {i: "\n".join(x) for i, x in want.items()}


def test_components_of_a_path_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(200, 200), (None, 3), (301, 300), (300, 301)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100 + i: 100 for i in range(20)} | {300: 300, 301: 300}
    assert connected_components(spark.createDataFrame([], "u string, v string")).count() == 0


def bag(text):
    words = (text or "").lower().split()
    return collections.Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else collections.Counter()


def jaccard(a, b):
    every = set(a) | set(b)
    return sum(1 / sum(max(a[d] / a[c], b[d] / b[c]) for d in every) for c in set(a) & set(b))


def brute_classes(rows):
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [(i, bag(t)) for i, t in rows]
    for k, (i, a) in enumerate(bags):
        for j, b in bags[:k]:
            if set(a) & set(b) and jaccard(a, b) >= 0.8:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def test_probability_jaccard_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = ({int(k): int(rng.integers(1, 5)) for k in rng.choice(12, 8, replace=False)} for _ in range(2))
        sides = [(np.array(sorted(x), dtype=np.uint64), np.array([x[k] for k in sorted(x)])) for x in (a, b)]
        assert near_duplicates.probability_jaccard(*sides) == pytest.approx(jaccard(collections.Counter(a), collections.Counter(b)))


def test_registers_agree_with_the_probability_jaccard():
    rng = np.random.default_rng(2)
    a = np.arange(1, 61, dtype=np.uint64)
    b = np.arange(11, 71, dtype=np.uint64)
    wa, wb = rng.integers(1, 4, 60), rng.integers(1, 4, 60)
    mixing = np.uint64(0x9E3779B97F4A7C15)
    agree = []
    for s in range(60):
        x, y = (near_duplicates.mixed(v * mixing + np.uint64(s)) for v in (a, b))
        sig = [near_duplicates.prob_minhash(np.zeros(60, int), c, w, 1)[0] for c, w in ((x, wa), (y, wb))]
        agree.append((sig[0] == sig[1]).mean())
    want = jaccard(collections.Counter(dict(zip(a.tolist(), wa.tolist()))), collections.Counter(dict(zip(b.tolist(), wb.tolist()))))
    assert np.mean(agree) == pytest.approx(want, abs=0.02)


def test_near_duplicates_equal_brute_force(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates.classes(docs).collect()}
    assert got == brute_classes([tuple(r) for r in docs.collect()])


def test_near_duplicate_corner_cases(spark):
    long = " ".join(f"w{i}" for i in range(200))
    near = " ".join("other" if i == 100 else f"w{i}" for i in range(200))
    rows = [(5, long), (4, near), (3, long.upper() + "  "), (9, None), (10, ""), (11, " \n"), (7, "a b"), (8, "A  b"), (12, "a b c"),
            (None, long), (5, long), (20, "first text of two"), (20, "w w w"), (21, "w w w")]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates.classes(table(spark, rows)).collect()}
    assert got == {5: 3, 4: 3, 3: 3, 9: 9, 10: 10, 11: 11, 7: 7, 8: 7, 12: 12, 20: 20, 21: 20}
    kept = near_duplicates.one_of_each_class(table(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "keys", "high.x"]
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 3, 7, 9, 10, 11, 12, 20]
    assert near_duplicates.classes(table(spark, [])).count() == 0


def test_further_hubs_find_links_the_first_hub_misses(spark, monkeypatch):
    # One register only, so that unlike texts share buckets: the least id is no hub for the others.
    monkeypatch.setattr(near_duplicates, "band_hashes", lambda s: np.repeat(np.ones((len(s), 1), dtype=np.uint64), near_duplicates.BANDS, axis=1))
    rng = np.random.default_rng(3)
    rows = []
    for group in range(6):
        words = [f"g{group}x{i}" for i in range(120)]
        for copy in range(4):
            own = list(words)
            own[int(rng.integers(120))] = f"edit{group}{copy}"
            rows.append((len(rows), " ".join(own)))
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates.classes(table(spark, rows)).collect()}
    assert got == {i: i // 4 * 4 for i, _ in rows} == brute_classes(rows)


def test_decontamination_tolerates_substitutions(spark):
    rng = np.random.default_rng(4)
    item = [f"item{i}" for i in range(40)]
    noise = lambda n: [f"n{rng.integers(10 ** 6)}" for _ in range(n)]
    edited = [w if i % 6 else "changed" for i, w in enumerate(item)]
    rows = [(1, " ".join(noise(30) + item + noise(30))), (2, " ".join(noise(10) + edited + noise(5))), (3, ", ".join(item).upper()),
            (4, " ".join(noise(20) + item[5:16] + noise(20))), (5, " ".join(noise(20) + item[5:17] + noise(20))), (6, None), (7, ""),
            (8, "a short item"), (9, "x six words stand in here y"), (None, " ".join(item)), (1, " ".join(noise(9)))]
    tests = spark.createDataFrame([(0, " ".join(item)), (1, "six words stand in here"), (2, "a short"), (3, None), (None, "q r s t u v w")], "item_id long, text string")
    found = decontamination.overlaps(table(spark, rows), tests).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in found) == [(0, 0), (1, 0), (2, 0), (3, 0), (5, 0), (9, 1)]
    run = next(r for r in found if r["doc_id"] == 1)
    assert (run["n_words"], run["n_equal"], run["doc_word"], run["item_word"], run["item_share"]) == (40, 40, 30, 0, 1.0)
    kept = decontamination.clean_rows(table(spark, rows), tests, block_bytes=64)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 6, 7, 8] and kept.columns == ["doc_id", "text", "lang", "keys", "high.x"]
    assert decontamination.overlaps(table(spark, rows), tests.limit(0)).count() == 0
    blocks = decontamination.overlaps(table(spark, rows), tests, block_bytes=64).collect()
    assert sorted(map(str, blocks)) == sorted(map(str, found))


def test_masks_catch_any_two_substitutions():
    for i in range(12):
        for j in range(i):
            assert any(i not in m and j not in m for m in decontamination.MASKS)


def test_decontamination_equals_a_scan_for_whole_items(spark, sf):
    docs, tests = read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.overlaps(docs, tests).collect()}
    plain = lambda t: " " + " ".join(t.lower().split()) + " "
    items = [(r["item_id"], plain(r["text"])) for r in tests.collect()]
    whole = {(d["doc_id"], i) for d in docs.collect() for i, t in items if t in plain(d["text"])}
    assert whole and whole <= found


def test_language_of_held_out_documents(spark, sf):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    model = language.fit(docs.where(bucket_of(F.col("doc_id"), 5) != 0))
    out, _ = language.identify(docs.where(bucket_of(F.col("doc_id"), 5) == 0), model)
    rows = out.select("lang", "lang_pred", "accepted", "score").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(r["accepted"] and 0 < r["score"] <= 1 for r in rows)


def test_language_corner_cases(spark):
    texts = {"aa": "la casa es grande y la mesa es verde ", "bb": "the house is big and the table is green "}
    docs = spark.createDataFrame([(i, texts[k] * 3 + str(i), k) for i, k in enumerate(["aa", "bb"] * 40)] + [(99, "x", None), (None, None, "aa")],
                                 "doc_id long, text string, lang string")
    model = language.fit(docs)
    odd = spark.createDataFrame([(1, "the table", 0), (2, None, 0), (3, "123 !!", 0), (4, "", 0), (5, "漢字かな交じり文を書く" * 20, 0), (1, "the table", 0)],
                                "doc_id long, text string, score int")
    out, added = language.identify(odd, model)
    got = {r["doc_id"]: (r[added["lang_pred"]], r[added["accepted"]], r["score"]) for r in out.collect()}
    assert added["score"] == "score_1" and got[1] == ("bb", True, 0)
    assert all(got[i] == ("und", False, 0) for i in (2, 3, 4)) and got[5][1] is False
    assert sorted(r["doc_id"] for r in language.accepted_rows(odd, model).collect()) == [1, 1]
    empty = language.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language.identify(docs, empty)[0].collect()} == {"und"}
    assert language.identify(odd.limit(0), model)[0].count() == 0


def test_line_key_hash_is_that_of_the_stripped_lower_line():
    assert line_dedup.line_key(f"\t {LONG.upper()} \r".encode()) == LONG.encode()
    assert line_dedup.digest(b"x") == hashlib.blake2b(b"x", digest_size=16).digest()
