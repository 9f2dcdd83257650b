"""Near-duplicate documents by ProbMinHash over weighted word shingles.

The weight of a five-word shingle is its count in the text.  Each shingle sends
the arrivals of a Poisson process with its weight as rate to random registers; a register keeps its
earliest arrival.  A shingle stops once its next arrival is later than every register.  Two
texts agree in a register with the probability Jaccard of their shingle weights.

Registers are banded.  Texts that are the same word for word are one node from
the start.  In each bucket, nodes are first compared with one hub, not with each other;
each compared pair is verified by its exact probability Jaccard.

What links do not yet join meets by rare shingles.  A pair of similarity t shares so much of its weight that the rarest
shingle both hold is among the first of either: a text lists its shingles that other undecided texts hold, rarest first, and
posts them up to the weight that a partner of the other's size could lack.  Postings meet by shingle and the sizes of
both, so a text next to the bound posts one or two shingles, and these are rarer than those its whole group holds.  Only pairs
of different classes meet, and what is left of both lists must still reach the bound.  So all pairs of undecided
texts that can reach it are compared, whatever their number in a bucket.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm import line_dedup
from loanloom.llm.components import connected_components
from loanloom.llm.frames import map_arrow, quoted, received, sent, stored
from loanloom.llm.tokens import mixed, shingles, slices, uniforms, words

SHINGLE, SIMILARITY = 5, 0.8
#: 16 bands of 4 registers: a pair of similarity 0.8 meets in no band with probability 2e-4, one of 0.85 with 1e-5.
BANDS, ROWS = 16, 4
#: Members that one task compares with a hub at a time.
MEMBERS_PER_CHUNK = 64
#: Sizes are told apart by this (in logarithms), and weights of repeated shingles by these shares of the size; a text with more is heavy.
SIZE_STEP = 0.02
REPEATED_SHARES = (0.0, 0.01, 0.05)
_HEAVY = -1
#: Members of different classes of a bucket of at most this many meet directly, those of a larger one by rare shingles.
SMALL_BUCKET = 16


def weighted(codes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of the distinct shingles of each row, sorted by row and hash."""
    row = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((codes, row))
    row, codes = row[order], codes[order]
    fresh = np.ones(len(codes), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (codes[1:] != codes[:-1])
    at = np.flatnonzero(fresh)
    return row[at], codes[at], np.diff(np.concatenate((at, [len(codes)])))


def prob_minhash(row: np.ndarray, codes: np.ndarray, weight: np.ndarray, rows: int, size: int = BANDS * ROWS) -> np.ndarray:
    """Signature of each row: the shingle with the earliest arrival of every register (0 for a row without shingles)."""
    earliest = np.full(rows * size, np.inf)
    owner = np.zeros(rows * size, dtype=np.uint64)
    time = np.zeros(len(codes))
    arrival = 0
    while len(codes):
        arrival += 1
        draw = mixed(codes + np.uint64((arrival * 0x9E3779B97F4A7C15) & (2 ** 64 - 1)))
        time = time - np.log(uniforms(draw)) / weight
        place = row * size + (draw & np.uint64(2047)).astype(np.int64) % size
        np.minimum.at(earliest, place, time)
        won = earliest[place] == time
        owner[place[won]] = codes[won]
        # Early termination: later arrivals of a shingle cannot win any more.
        going = time < earliest.reshape(rows, size).max(axis=1)[row]
        row, codes, weight, time = row[going], codes[going], weight[going], time[going]
    return owner.reshape(rows, size)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    out = np.zeros((len(signature), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        h = np.full(len(signature), b + 1, dtype=np.uint64)
        for r in range(ROWS):
            h = mixed(h * np.uint64(0x2545F4914F6CDD1D) + signature[:, b * ROWS + r])
        out[:, b] = h
    return out


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two weighted sets, each sorted hashes with weights."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = a[1][i].astype(float), b[1][j].astype(float)
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    # Sum over d of max(x_d / x_c, y_d / y_c): x rules up to the ratio y_c / x_c, y beyond it.
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    below = only_a + np.cumsum(x)
    above = only_b + y.sum() - np.cumsum(y)
    return float((1.0 / (below / x + above / y)).sum())


def bag(text) -> tuple[np.ndarray, np.ndarray]:
    codes, first = words(pa.array([text], pa.large_string()))
    _, distinct, count = weighted(*shingles(codes, first, SHINGLE))
    return distinct, count


def _signed(rows: DataFrame) -> DataFrame:
    """doc_id, fingerprint of the word sequence, number of shingles, and band hashes of the rows with words."""
    def work(batches):
        for batch in batches:
            text = batch.column("text")
            at, high, low, size, bands = [], [], [], [], []
            for a, b in slices(text):
                codes, first = words(text.slice(a, b - a))
                held = np.flatnonzero(np.diff(first))
                row, shingle, weight = weighted(*shingles(codes, first, SHINGLE))
                bands.append(band_hashes(prob_minhash(row, shingle, weight, rows=b - a)[held]))
                size.append(np.bincount(row, weight, b - a).astype(np.int64)[held])
                at.append(a + held)
                for r in held.tolist():
                    digest = hashlib.blake2b(codes[first[r]:first[r + 1]].tobytes(), digest_size=16).digest()
                    high.append(int.from_bytes(digest[:8], "little", signed=True))
                    low.append(int.from_bytes(digest[8:], "little", signed=True))
            at = np.concatenate(at) if at else np.zeros(0, int)
            flat = np.concatenate(bands).view(np.int64).ravel() if bands else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * BANDS), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(high, pa.int64()),
                                              pa.array(low, pa.int64()), pa.array(np.concatenate(size) if size else np.zeros(0, np.int64)), lists],
                                             ["doc_id", "high", "low", "size", "bands"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, work, f"doc_id {kind}, high long, low long, size long, bands array<bigint>")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (node, hub) whose exact similarity reaches the bound.

    The members of a hub go to chunks, each with its own copy of the hub's text; a task
    reads one hub and then streams its members.
    """
    kind = pairs.schema["node"].dataType.simpleString()
    loads = stored(pairs.groupBy("hub").agg(F.ceil(F.count("*") / F.lit(MEMBERS_PER_CHUNK)).cast("int").alias("chunks")), "near-loads")
    dealt = pairs.join(loads.hint("merge"), "hub").select("hub", "node", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"))
    members = dealt.join(texts.hint("merge"), dealt["node"] == texts["doc_id"]).select("hub", "chunk", F.lit(1).alias("member"), "node", "text")
    hubs = (loads.join(texts.hint("merge"), loads["hub"] == texts["doc_id"])
            .select("hub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("member"), F.col("hub").alias("node"), "text"))

    def work(batches):
        own, hub_bags = None, []
        for batch in batches:
            nodes, found = [], []
            columns = [batch.column(c).to_pylist() for c in ("hub", "chunk", "member", "node")]
            text = batch.column("text")
            for i, (hub, chunk, member, node) in enumerate(zip(*columns)):
                if (hub, chunk) != own:
                    own, hub_bags = (hub, chunk), []
                mine = bag(text[i].as_py())
                if not member:
                    hub_bags.append(mine)  # more than one only where a document id repeats
                elif any(probability_jaccard(mine, b) >= SIMILARITY for b in hub_bags):
                    nodes.append(node)
                    found.append(hub)
            kind = batch.schema.field("node").type
            yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array(found, kind)], ["node", "hub"])

    met = members.union(hubs).repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", "member")
    return map_arrow(met, work, f"node {kind}, hub {kind}").distinct()


def _own_share(texts: DataFrame, size: int) -> tuple[DataFrame, Broadcast]:
    """(node, size, texts, flat, own, kinds): shingles of a text, whether each occurs once, the share (at least) that no other text
    holds, and the classes of size and repeats of its texts.

    The second result is the twice-seen filter, for :func:`received`.

    ``size`` is about the number of shingles of all texts.  A false positive of the filter makes ``own`` smaller, so it
    can only add pairs.  Of several texts with one id the one with the least of its own speaks for the id.
    """
    def hashed(batches):
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text):
                codes, first = words(text.slice(a, b - a))
                row, code, _ = weighted(*shingles(codes, first, SHINGLE))
                ends = pa.array(np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(x.view(np.int64))) for x in (code, mixed(code))], ["high", "low"])

    bits = line_dedup.filter_bits(size)
    keys = map_arrow(texts.select("text"), hashed, "high array<bigint>, low array<bigint>")
    twice = stored(line_dedup.twice_seen(keys, bits), "near-filter")
    held = sent(texts.sparkSession, line_dedup.probe_filter(twice, bits))

    def counted(batches):
        table, folded = received(held)
        for batch in batches:
            text = batch.column("text")
            size, flat, own, step, kind = [], [], [], [], []
            for a, b in slices(text):
                codes, first = words(text.slice(a, b - a))
                row, code, weight = weighted(*shingles(codes, first, SHINGLE))
                alone = ~line_dedup.seen_twice(table, folded, code.view(np.int64), mixed(code).view(np.int64))
                size.append(np.bincount(row, weight, b - a))
                step.append(size_class(np.maximum(size[-1], 1)))
                kind.append(repeated_class(size[-1], size[-1] - np.bincount(row, minlength=b - a)))
                flat.append(np.bincount(row, weight > 1, b - a) == 0)
                own.append(np.bincount(row, weight * alone, b - a))
            columns = [np.concatenate(x) if x else np.zeros(0) for x in (size, flat, own, step, kind)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(bool)),
                                              *[pa.array(x.astype(np.int64)) for x in columns[2:]]], ["node", "size", "flat", "own", "step", "kind"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    found = map_arrow(texts.select("doc_id", "text"), counted, f"node {kind}, size long, flat boolean, own long, step long, kind long")
    shares = found.groupBy("node").agg(F.max("size").alias("size"), F.count("*").alias("texts"), F.min("flat").alias("flat"), F.min(F.col("own") / F.col("size")).alias("own"),
                                        F.collect_set(F.struct("step", "kind")).alias("kinds"))
    return shares, held


def _can_reach(a: str, b: str):
    """Whether two texts can have the similarity asked for, from their sizes and the shares only they hold.

    With own shares u and v the probability Jaccard is at most the mean of (1-u)/(1+u) and (1-v)/(1+v).  Where all
    shingles occur once it is the plain Jaccard, and what is common is no more than either's rest: with
    sizes x and y, (1-u) x >= (x + y) t / (1+t), and the same for v and y.
    """
    share = SIMILARITY / (1 + SIMILARITY)
    u, v = F.col(f"{a}.own"), F.col(f"{b}.own")
    x, y = F.col(f"{a}.size"), F.col(f"{b}.size")
    mean = (1 - u) / (1 + u) + (1 - v) / (1 + v) >= 2 * SIMILARITY - 1e-9
    plain = ((1 - u) * x >= (x + y) * share - 1e-6) & ((1 - v) * y >= (x + y) * share - 1e-6)
    single = F.col(f"{a}.flat") & F.col(f"{b}.flat") & (F.col(f"{a}.texts") == 1) & (F.col(f"{b}.texts") == 1)
    return mean & (~single | plain)


def size_class(size: np.ndarray | int) -> np.ndarray:
    return np.floor(np.log(size) / SIZE_STEP + 1e-9).astype(np.int64)


def repeated_class(size: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """Which of ``REPEATED_SHARES`` bounds the weight beyond the first of each shingle; ``_HEAVY`` for none."""
    out = np.full(len(size), _HEAVY, dtype=np.int64)
    for k in reversed(range(len(REPEATED_SHARES))):
        out[repeated <= REPEATED_SHARES[k] * size] = k
    return out


def allowances(size: int, shared: int, repeated: int, partners: list[tuple[int, int]]) -> list[tuple[int, int, float]]:
    """(partner's size class, partner's repeats, weight): how much shared weight a text may lack of a partner of each of these classes.

    With sizes x and y, common weight c of x and repeats r of y the probability Jaccard is at most
    (c + r) / (x + y - c - r), and c / x at most; the second alone holds for heavy texts.  Classes whose texts cannot be partners are left out.
    """
    out = []
    heavy = int(repeated_class(np.array([size]), np.array([repeated]))[0]) == _HEAVY or any(p == _HEAVY for _, p in partners)
    light = [p for p in partners if p[1] != _HEAVY]
    share = SIMILARITY / (1 + SIMILARITY)
    most = shared - SIMILARITY * size
    if most < -1e-6:
        return []
    if int(repeated_class(np.array([size]), np.array([repeated]))[0]) != _HEAVY:
        for step, partner in light:
            low, high = np.exp(step * SIZE_STEP), np.exp((step + 1) * SIZE_STEP)
            spare = REPEATED_SHARES[partner] * high
            # Of the partner no more than all can be common.
            if high + repeated < (size + high) * share - 1e-6:
                continue
            weight = min(most, shared + spare - (size + np.ceil(low * (1 - 1e-9))) * share)
            if weight >= -1e-6:
                out.append((step, partner, float(weight)))
    if heavy:
        out.append((0, _HEAVY, float(most)))
    return out


def _rare_pairs(texts: DataFrame, labels: DataFrame, twice_filter: Broadcast) -> DataFrame:
    """(node, hub): all pairs of texts of different labels that may reach the bound, by their rarest common shingle.

    ``labels`` holds each node with its label and the classes its partners may be of (``partners``).
    """
    kind = texts.schema["doc_id"].dataType.simpleString()

    def suspected(batches):
        table, folded = received(twice_filter)
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text):
                codes, first = words(text.slice(a, b - a))
                row, code, weight = weighted(*shingles(codes, first, SHINGLE))
                size, distinct = np.bincount(row, weight, b - a).astype(np.int64), np.bincount(row, minlength=b - a)
                again = line_dedup.seen_twice(table, folded, code.view(np.int64), mixed(code).view(np.int64))
                row, code, weight = row[again], code[again], weight[again]
                at = pa.array(row + a)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("part").take(at), pa.array(size[row]),
                                                  pa.array(size[row] - distinct[row]), pa.array(code.view(np.int64)), pa.array(weight.astype(np.int64))],
                                                 ["node", "part", "size", "repeated", "code", "weight"])

    # Texts of one id are told apart by a hash of the text.
    rows = texts.select("doc_id", F.xxhash64("text").alias("part"), "text")
    held = stored(map_arrow(rows, suspected, f"node {kind}, part long, size long, repeated long, code long, weight long"), "near-shingles")
    often = held.groupBy("code").agg(F.countDistinct("node", "part").alias("n")).where("n > 1")
    lists = held.join(often, "code").groupBy("node", "part").agg(
        F.first("size").alias("size"), F.first("repeated").alias("repeated"), F.array_sort(F.collect_set(F.struct("n", "code", "weight"))).alias("held"))
    lists = stored(lists.join(labels, "node").select("node", "label", "partners", "size", "repeated", F.col("held.code").alias("codes"), F.col("held.weight").alias("weights")), "near-lists")
    def posted(batches):
        names = ["code", "own_step", "own_kind", "step", "kind", "node", "label", "size", "repeated", "rest"]
        for batch in batches:
            columns = {c: np.asarray(batch.column(c)) for c in ("size", "repeated")}
            steps, kinds = size_class(columns["size"]), repeated_class(columns["size"], columns["repeated"])
            parts = []
            met = [[(p["step"], p["kind"]) for p in of] for of in batch.column("partners").to_pylist()]
            for i, (codes, weights) in enumerate(zip(batch.column("codes"), batch.column("weights"))):
                code, weight = np.asarray(codes.values), np.asarray(weights.values)
                total, before = int(weight.sum()), np.cumsum(weight) - weight
                for step, partner, allowed in allowances(int(columns["size"][i]), total, int(columns["repeated"][i]), met[i]):
                    n = int(np.searchsorted(before, allowed + 1e-6, side="right"))
                    # In the class-free lists a light text is of no class either.
                    free = partner == _HEAVY
                    own = (0, _HEAVY) if free else (int(steps[i]), int(kinds[i]))
                    parts.append((code[:n], np.full(n, own[0]), np.full(n, own[1]), np.full(n, step), np.full(n, partner), np.full(n, i), total - before[:n]))
            if parts:
                code, own_step, own_kind, step, partner, at, rest = (np.concatenate(p) for p in zip(*parts))
                index = pa.array(at)
                arrays = [pa.array(x.astype(np.int64)) for x in (code, own_step, own_kind, step, partner)]
                arrays += [batch.column(c).take(index) for c in ("node", "label", "size", "repeated")] + [pa.array(rest.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, names)

    postings = stored(map_arrow(lists, posted, "code long, own_step long, own_kind long, step long, kind long, "
                                f"node {kind}, label {kind}, size long, repeated long, rest long"), "near-rare")
    # A list is known by its shingle and the classes of both sides; one where all have the same label has no pairs.  Of any pair one is
    # not of the commonest label.
    own, other = (F.struct(F.col(a).alias("step"), F.col(b).alias("kind")) for a, b in (("own_step", "own_kind"), ("step", "kind")))
    keyed = postings.withColumn("ends", F.array(F.least(own, other), F.greatest(own, other)))
    mixed_lists = stored(keyed.groupBy("code", "ends").agg(F.mode("label").alias("common"), F.min("label").alias("a"), F.max("label").alias("b"))
                         .where("a <> b").select("code", "ends", "common"), "near-mixed")
    open_ = stored(keyed.join(mixed_lists.hint("merge"), ["code", "ends"]).drop("ends"), "near-open-lists")
    x, y = open_.where("label <> common").alias("x"), open_.alias("y")
    need = (F.col("x.size") + F.col("y.size")) * F.lit(SIMILARITY / (1 + SIMILARITY)) - 1e-6
    reach = (F.col("x.rest") + F.col("y.repeated") >= need) & (F.col("y.rest") + F.col("x.repeated") >= need)
    for side in ("x", "y"):
        reach &= F.col(f"{side}.rest") >= SIMILARITY * F.col(f"{side}.size") - 1e-6
    heavy_pair = F.greatest(*[F.col(f"{s}.repeated") / F.col(f"{s}.size") for s in "xy"]) > REPEATED_SHARES[-1]
    same_list = ((F.col("x.code") == F.col("y.code")) & (F.col("x.own_step") == F.col("y.step")) & (F.col("x.own_kind") == F.col("y.kind"))
                 & (F.col("x.step") == F.col("y.own_step")) & (F.col("x.kind") == F.col("y.own_kind")))
    met = x.join(y.hint("merge"), same_list & (F.col("x.label") != F.col("y.label")) & ((F.col("x.kind") != _HEAVY) | heavy_pair) & reach)
    return met.select(F.greatest("x.node", "y.node").alias("node"), F.least("x.node", "y.node").alias("hub")).distinct()


def _open_members(posted: DataFrame, label: DataFrame) -> DataFrame:
    """(bucket, node, label) of the buckets whose members are in different classes."""
    named = (posted.join(label.hint("merge"), posted["node"] == label["node"], "left")
             .select("bucket", posted["node"], F.coalesce("component", posted["node"]).alias("label")))
    open_buckets = stored(named.groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("bucket"), "near-open")
    return stored(named.join(open_buckets.hint("merge"), "bucket"), "near-members")


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, class_id, copy_of): the class of every document id and the least id of equal word sequence.

    A class is a connected component of pairs of similarity ``SIMILARITY`` or more; its id is its
    least document id.  Case and white space do not count.  A text of fewer than five words is one
    shingle.  A text that is null or has no word is a class of its own.  Rows of one id are one
    document, with any link that one of its texts has.  A null id has no row in the result.
    """
    rows = docs.select(quoted(id_column).alias("doc_id"), quoted(text_column).alias("text")).where("doc_id is not null")
    signed = stored(_signed(rows), "near-signatures")
    same = stored(signed.groupBy("high", "low").agg(F.min("doc_id").alias("node"), F.first("size").alias("size"), F.first("bands").alias("bands")), "near-nodes")
    copies = stored(signed.select("doc_id", "high", "low").join(same.select("high", "low", "node").hint("merge"), ["high", "low"])
                    .select("doc_id", "node").distinct(), "near-copies")
    posted = same.select("node", F.explode("bands").alias("bucket"))
    shared = stored(posted.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("hub")).where("n > 1").select("bucket", "hub"), "near-buckets")
    posted = stored(posted.join(shared.hint("merge"), "bucket").select("bucket", "hub", "node"), "near-postings")
    texts = stored(rows.join(posted.select(F.col("node").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi"), "near-texts")

    # First each node with the least hub of its buckets.
    pairs = stored(posted.where("node <> hub").groupBy("node").agg(F.min("hub").alias("hub")), "near-pairs")
    done, links = pairs, stored(_verified(pairs, texts), "near-links")
    # Two texts of one id tie their nodes together.
    twice = stored(copies.groupBy("doc_id").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub <> top").select("doc_id", "hub"), "near-twice")
    links = stored(links.union(copies.join(twice.hint("merge"), "doc_id").where("node <> hub").select("node", "hub")), "near-links")
    label = stored(connected_components(links, "node", "hub"), "near-labels")

    # Then the pairs of different classes that can reach the bound, hub by hub.
    members = _open_members(posted, label)
    undecided = stored(members.select(F.col("node").alias("doc_id")).distinct(), "near-undecided")
    own_texts = stored(texts.join(undecided.hint("merge"), "doc_id", "left_semi"), "near-own-texts")
    size = same.join(undecided.hint("merge"), same["node"] == undecided["doc_id"], "left_semi").agg(F.sum("size")).first()[0] or 1
    shares, twice_filter = _own_share(own_texts, size)
    shares = stored(shares, "near-shares")
    # A text of which more than this is its own is like no other.
    shares = shares.where(F.col("own") <= 1 - SIMILARITY + 1e-9)
    about = shares.select("node", F.struct("size", "flat", "texts", "own").alias("about"))

    def joined(pairs):
        """Labels and open members after verifying ``pairs``; the classes so far are stars already, only new links change them."""
        fresh = stored(_verified(pairs, texts), "near-links")
        if fresh.isEmpty():
            return label, members
        links = label.where("node <> component").toDF("node", "hub").union(fresh)
        merged = stored(connected_components(links, "node", "hub"), "near-labels")
        return merged, _open_members(posted, merged)

    # Second hub of an open bucket is the member that meets the most others, of equal ones that with the least of its own.
    live = stored(members.join(about.hint("merge"), "node"), "near-live")
    crowd = live.join(live.groupBy("bucket").agg(F.count("*").alias("n")).hint("merge"), "bucket").groupBy("node").agg(F.sum("n").alias("met"))
    order = F.struct((-F.col("met")).alias("less"), F.col("about.own").alias("own"), "node", "label", "about")
    chosen = live.join(stored(crowd, "near-crowd").hint("merge"), "node").groupBy("bucket").agg(F.min(order).alias("first"))
    chosen = stored(chosen.select("bucket", F.col("first.node").alias("hub"), F.col("first.label").alias("hub_label"), F.col("first.about").alias("hub_about")), "near-hubs")
    met = live.join(chosen.hint("merge"), "bucket").where((F.col("label") != F.col("hub_label")) & _can_reach("about", "hub_about"))
    pairs = met.select(F.greatest("node", "hub").alias("node"), F.least("node", "hub").alias("hub")).distinct()
    pairs = stored(pairs.join(done, ["node", "hub"], "left_anti"), "near-pairs")
    done = done.union(pairs)
    label, members = joined(pairs)
    # Then what is still in different classes: members of small buckets directly, those of others by rare shingles.
    live = stored(members.join(about.hint("merge"), "node"), "near-live")
    counts = stored(live.groupBy("bucket").agg(F.count("*").alias("n"), F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("bucket", "n"), "near-still")
    few = live.join(counts.where(F.col("n") <= SMALL_BUCKET).select("bucket").hint("merge"), "bucket")
    one, two = few.alias("one"), few.select("bucket", F.col("node").alias("hub"), F.col("label").alias("hub_label"), F.col("about").alias("hub_about"))
    pairs = one.join(two.hint("merge"), "bucket").where((F.col("node") > F.col("hub")) & (F.col("label") != F.col("hub_label")) & _can_reach("about", "hub_about")).select("node", "hub").distinct()
    many = stored(live.join(counts.where(F.col("n") > SMALL_BUCKET).select("bucket").hint("merge"), "bucket").select("bucket", "node", "label"), "near-many")
    if not many.isEmpty():
        # The classes that a node may meet are those of its buckets.
        kinds = many.join(shares.select("node", F.explode("kinds").alias("of")).hint("merge"), "node").select("bucket", "of").distinct()
        partners = many.join(kinds.groupBy("bucket").agg(F.collect_list("of").alias("of")).hint("merge"), "bucket").groupBy("node", "label").agg(
            F.array_distinct(F.flatten(F.collect_set("of"))).alias("partners"))
        left = stored(partners, "near-left")
        many_texts = own_texts.join(left.select(F.col("node").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
        pairs = pairs.union(_rare_pairs(many_texts, left, twice_filter)).distinct()
    pairs = stored(pairs.join(done, ["node", "hub"], "left_anti"), "near-pairs")
    label, members = joined(pairs)
    found = copies.join(label.hint("merge"), copies["node"] == label["node"], "left").select(
        "doc_id", F.coalesce("component", copies["node"]).alias("class_id"), copies["node"].alias("copy_of"))
    found = found.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.min("copy_of").alias("copy_of"))
    wordless = rows.select("doc_id").distinct().join(found.select("doc_id"), "doc_id", "left_anti")
    return found.union(wordless.select("doc_id", F.col("doc_id"), F.col("doc_id")))


def one_of_each_class(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of the least document id of each class, all columns; of rows with one id, one stays.

    Rows with a null id stay.
    """
    key = quoted(id_column)
    kept = classes(docs, id_column, text_column).where("doc_id = class_id").select(F.col("doc_id").alias("_kept_id"))
    once = docs.join(kept.hint("merge"), key == F.col("_kept_id"), "left_semi").dropDuplicates([id_column])
    return once.union(docs.where(key.isNull()))
