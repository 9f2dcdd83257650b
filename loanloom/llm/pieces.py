"""Sampled SentencePiece segmentations without replacement, and decoding.

A text is a lattice of vocabulary pieces.  A segmentation's probability is the product of
piece weights, which fall with the rank of a piece in the vocabulary (the
vocabulary is one of merges, whose scores are ranks), over the sum for all segmentations.  Pieces never cross from a
word into the blank after it, so the lattice is a chain of small ones, built once for each
distinct word of a slice of rows.

Distinct segmentations are drawn by A* search with Gumbel perturbations.  A region
is all segmentations that share a prefix and then leave it by other edges than
those named; its bound is the largest perturbed log-probability inside it.
The search takes the region with the largest bound, samples down to one segmentation, which
attains the bound, and splits the rest of the region along that path, each part with a
Gumbel of its own mass truncated at the bound.  The order of visits is a sample
without replacement.  Randomness is a hash of the row key, so a retried task draws the same.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loanloom.llm.frames import map_arrow, received, sent, unused
from loanloom.llm.tokens import mixed, sequence_hashes, slices, uniforms

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
#: The probability of a piece is proportional to 1 / (rank + this).
RANK_SHIFT = 10
#: Exponent of the piece probabilities: the smaller, the more even the segmentations.
ALPHA = 0.2
#: Text bytes worked on at once.
CHUNK = 1 << 20
_STEP, _SPREAD, _TABLE_BITS = 0x100000001B3, 0x9E3779B97F4A7C15, 17
_QUANTA = float(1 << 30)


@dataclass
class Vocabulary:
    """Pieces with a plain blank for the blank mark, found by a hash of their characters; byte pieces apart."""
    keys: np.ndarray        # open-address table of the hashes of all pieces and what begins a piece (0: free)
    entries: np.ndarray     # piece id, or -1 for what only begins a piece
    logs: np.ndarray        # id -> log-probability
    byte_ids: np.ndarray
    byte_cost: float
    decoded: list           # id -> bytes

    @staticmethod
    def load(path: str = MODEL_PATH, alpha: float = ALPHA) -> Vocabulary:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        byte_ids, plain, decoded = [0] * 256, [], [b""] * size
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:-1], 16)] = i
                decoded[i] = bytes([int(piece[3:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain.append((i, piece.replace("\u2581", " ")))
                decoded[i] = plain[-1][1].encode()
        weights = 1.0 / (np.arange(len(plain)) + RANK_SHIFT)
        values = alpha * np.log(weights / weights.sum())
        logs = np.zeros(size)
        logs[[i for i, _ in plain]] = values
        known: dict[str, int] = {}
        for i, piece in plain:
            for n in range(1, len(piece)):
                known.setdefault(piece[:n], -1)
            known[piece] = i
        keys = np.zeros(1 << _TABLE_BITS, dtype=np.uint64)
        entries = np.zeros(1 << _TABLE_BITS, dtype=np.int32)
        for piece, i in known.items():
            h = 0
            for c in piece:
                h = (h * _STEP + ord(c) + 1) % (1 << 64)
            slot = (h * _SPREAD % (1 << 64)) >> (64 - _TABLE_BITS)
            while keys[slot]:
                slot = (slot + 1) % len(keys)
            keys[slot], entries[slot] = h, i
        # A byte costs more than the rarest piece, so that it only stands where no piece does.
        return Vocabulary(keys, entries, logs, np.array(byte_ids), float(values.min()) - 2.0 * alpha, decoded)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece id of each hash, -1 for what only begins a piece, -2 for neither."""
        out = np.full(len(hashes), -2, dtype=np.int32)
        slot = ((hashes * np.uint64(_SPREAD)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        open_ = np.arange(len(hashes))
        while len(open_):
            there = self.keys[slot]
            same = there == hashes[open_]
            out[open_[same]] = self.entries[slot[same]]
            more = ~same & (there != 0)
            open_, slot = open_[more], (slot[more] + 1) % len(self.keys)
        return out


class Lattices:
    """Lattices of distinct parts as one graph: a node is a character, its edges lie in a row.

    Nodes are numbered in layers by how far they are from the end of their part, and in a layer by their part, longest
    parts first.  So the mass from a node on is found a layer at a time, each of them a stretch of nodes and of edges.
    """

    def __init__(self, vocabulary: Vocabulary, codes: np.ndarray, sizes: np.ndarray):
        """``codes`` holds the characters of all parts, ``sizes`` how many each has."""
        n, longest = len(codes), int(sizes.max(initial=0))
        order = np.argsort(-sizes, kind="stable")
        falling = -sizes[order]
        width = np.searchsorted(falling, -np.arange(1, longest + 1), side="right")
        layer = np.concatenate(([0], np.cumsum(width))).astype(np.int32)
        self.roots = np.empty(len(sizes), dtype=np.int32)
        self.roots[order] = layer[-falling - 1] + np.arange(len(sizes), dtype=np.int32)
        left = np.repeat(np.arange(1, longest + 1, dtype=np.int32), width)
        rank = np.arange(n, dtype=np.int32) - layer[left - 1]
        at = np.cumsum(sizes)[order].astype(np.int32)[rank] - left
        codes = codes.astype(np.int32, copy=False)
        # Edges by piece length, while what has been read still begins a piece.
        found_at, found_piece, found_target = [], [], []
        degree = np.zeros(n, dtype=np.int32)
        node, h, size = np.arange(n, dtype=np.int32), np.zeros(n, dtype=np.uint64), 0
        while len(node):
            h = h * np.uint64(_STEP) + (codes[at + size] + 1).astype(np.uint64)
            size += 1
            found = vocabulary.find(h)
            # A character that no piece covers stands for itself.
            piece = np.where(found < 0, -1 - codes[at], found) if size == 1 else found
            hit = slice(None) if size == 1 else np.flatnonzero(found >= 0)
            here, gap = node[hit], left[hit] - size
            degree[here] += 1
            found_at.append(here)
            found_piece.append(piece[hit])
            found_target.append(np.where(gap > 0, layer[gap - 1] + rank[hit], -1))
            going = np.flatnonzero((found >= -1) & (left > size))
            node, at, h, left, rank = node[going], at[going], h[going], left[going], rank[going]
        self.first = np.zeros(n + 1, dtype=np.int32)
        np.cumsum(degree, out=self.first[1:])
        edges = int(self.first[-1])
        self.piece, self.target = np.empty(edges, np.int32), np.empty(edges, np.int32)
        self.node = np.repeat(np.arange(n, dtype=np.int32), degree)
        free = self.first[:-1].copy()
        for here, piece, target in zip(found_at, found_piece, found_target):
            to = free[here]
            self.piece[to], self.target[to] = piece, target
            free[here] = to + 1
        self.log = vocabulary.logs[np.maximum(self.piece, 0)]
        raw = np.flatnonzero(self.piece < 0)
        c = -1 - self.piece[raw]
        self.log[raw] = vocabulary.byte_cost * (1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF))
        # Mass from a node to the end of its part, for all parts at once from their ends.
        after = np.zeros(n + 1)    # the last is that of an ended part: -1
        for low, high in zip(layer[:-1].tolist(), layer[1:].tolist()):
            a, b = self.first[low], self.first[high]
            w, spread = self.log[a:b], degree[low:high]
            w += after[self.target[a:b]]
            heads = self.first[low:high] - a
            top = np.maximum.reduceat(w, heads)
            total = top + np.log(np.add.reduceat(np.exp(w - np.repeat(top, spread)), heads))
            after[low:high] = total
            w -= np.repeat(total, spread)
        # Probability of an edge and the earlier ones of its node, added within the node alone and in
        # steps that stay exact beside the node number: a draw must not hang on what else is in the slice.
        share = np.exp(self.log)
        more, passed = np.flatnonzero(degree > 1), 1
        while len(more):
            e = self.first[more] + passed
            share[e] += share[e - 1]
            passed += 1
            more = more[degree[more] > passed]
        self.reach = self.node + np.rint(share * _QUANTA) / _QUANTA
        if n:
            self.reach[self.first[1:] - 1] = np.arange(n) + 1.0


class Search:
    """The perturbed A* search over a slice of rows at once."""

    def __init__(self, vocabulary: Vocabulary, texts: list[str], seeds: np.ndarray, samples: int):
        whole = "".join([" " + t for t in texts if t])
        codes = np.frombuffer(whole.encode("utf-32-le"), dtype=np.int32)
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
        # A part is a line end, or blanks and the word after them.
        blank, line = codes == 32, codes == 10
        head = line.copy()
        head[1:] |= line[:-1] | (blank[1:] & ~blank[:-1])
        rows_at = np.cumsum(sizes) - sizes
        head[rows_at[sizes > 0]] = True
        starts = np.flatnonzero(head)
        stops = np.append(starts[1:], len(codes))
        counts = np.diff(np.searchsorted(starts, np.append(rows_at, len(codes))))
        # Each distinct part once, by the hash of its characters.
        hashed = pa.array(sequence_hashes(mixed(codes.astype(np.uint64)), starts, stops)).dictionary_encode()
        which = np.asarray(hashed.indices)
        once = np.empty(len(hashed.dictionary), dtype=np.int64)
        once[which] = np.arange(len(which))
        width = stops[once] - starts[once]
        at = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(starts[once], width)
        graph = Lattices(vocabulary, codes[at], width)
        self.first, self.reach, self.log, self.target, self.piece, self.node = graph.first, graph.reach, graph.log, graph.target, graph.piece, graph.node
        self.roots = graph.roots[which]
        self.begin = np.concatenate(([0], np.cumsum(counts)))
        self.row = np.repeat(np.arange(len(texts)), counts)
        self.seeds, self.samples, self.draws = seeds, samples, 0

    def _uniform(self, row: np.ndarray, place: np.ndarray, salt: int) -> np.ndarray:
        key = self.seeds[row] + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((salt * 0xD1B54A32D192ED03) & (2 ** 64 - 1))
        return uniforms(mixed(key))

    def _descend(self, parts: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ancestral samples through ``parts`` from ``nodes``: the part and edge of every step."""
        self.draws += 1
        steps, going, here, step = [], np.arange(len(parts), dtype=np.int32), nodes, 0
        row = self.row[parts]
        place = parts - self.begin[row]
        taken = np.zeros(len(parts), dtype=np.int32)
        while len(going):
            u = self._uniform(row, place, (self.draws << 32) + step)
            edges = self.first[here]
            goal = here + np.floor(u * _QUANTA) / _QUANTA
            # Few edges leave a node: walk along them.
            open_ = np.flatnonzero(self.reach[edges] <= goal)
            while len(open_):
                passed = edges[open_] + 1
                edges[open_] = passed
                open_ = open_[self.reach[passed] <= goal[open_]]
            step += 1
            steps.append((going, edges))
            taken[going] = step
            after = self.target[edges]
            on = np.flatnonzero(after >= 0)
            going, here, row, place = going[on], after[on], row[on], place[on]
        # Every part's steps in a row.
        begins = np.cumsum(taken) - taken
        chosen = np.empty(int(taken.sum()), dtype=np.int32)
        for k, (part, edges) in enumerate(steps):
            chosen[begins[part] + k] = edges
        return np.repeat(np.arange(len(parts)), taken), chosen

    def run(self) -> list[list[tuple[np.ndarray, float, float]]]:
        """For each row its samples, in order of their perturbed log-probabilities: edges, log-probability, log inclusion score."""
        rows = len(self.begin) - 1
        paths: list[list] = [[] for _ in range(rows)]     # (parts, edges, log before each step, bound)
        queues: list[list] = [[] for _ in range(rows)]    # (bound, path, step, mass left out)
        live = [r for r in range(rows) if self.begin[r + 1] > self.begin[r]]
        bounds = dict(zip(live, (-np.log(-np.log(self._uniform(np.array(live, np.int64), np.zeros(len(live), np.int64), 1)))).tolist()))
        starts = {r: (None, int(self.begin[r]), int(self.roots[self.begin[r]]), bounds[r]) for r in live}
        for turn in range(self.samples):
            if not starts:
                break
            self._follow(starts, paths, queues, turn)
            starts = self._choose(paths, queues) if turn + 1 < self.samples else {}
        out = []
        for r in range(rows):
            # The largest bound not visited is the threshold of the inclusion scores.
            threshold = max((q[0] for q in queues[r]), default=-np.inf)
            found = []
            for _, edges, before, _ in paths[r]:
                logp = float(before[-1] + self.log[edges[-1]])
                gap = logp - threshold
                score = 0.0 if gap > 30 else (gap if gap < -30 else float(np.log(-np.expm1(-np.exp(gap)))))
                found.append((edges, logp, min(score, 0.0)))
            out.append(found)
        return out

    def _follow(self, starts: dict, paths: list, queues: list, turn: int) -> None:
        """Completes a path for each start (prefix, part, node, bound) and splits what it leaves."""
        order = sorted(starts)
        parts = np.concatenate([np.arange(starts[r][1], self.begin[r + 1]) for r in order])
        sizes = np.array([self.begin[r + 1] - starts[r][1] for r in order])
        heads = np.cumsum(sizes) - sizes
        nodes = self.roots[parts]
        # A start of node -1 has just ended its part, which then has no step of its own.
        nodes[heads] = [starts[r][2] for r in order]
        live = nodes >= 0
        which, edges = self._descend(parts[live], nodes[live])
        step_part = parts[live][which]
        cuts = np.searchsorted(step_part, [*(self.begin[r] for r in order), self.begin[order[-1] + 1]])
        counts = np.diff(cuts)
        logs = self.log[edges]
        # Log-probability of what precedes each step of its row.
        fixed = [starts[r][0] for r in order]
        base = np.array([0.0 if p is None else p[2][-1] + self.log[p[1][-1]] for p in fixed])
        before = np.empty(len(logs))
        before[1:] = logs[:-1]
        before[cuts[:-1][counts > 0]] = base[counts > 0]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            np.cumsum(before[a:b], out=before[a:b])
        # Bound of the part left at each step: a Gumbel of the mass of the other edges, truncated at the bound of the path.
        others = np.log(-np.expm1(np.minimum(logs, 0.0)) + 1e-300)
        waits = -np.log(self._uniform(self.row[step_part], np.arange(len(edges)) - np.repeat(cuts[:-1], counts), ((self.draws + 1) << 32) - 1))
        late = np.where(others > -600, np.log(waits) - before - others, np.inf)
        need = self.samples - turn
        for k, r in enumerate(order):
            a, b = cuts[k], cuts[k + 1]
            path = (step_part[a:b], edges[a:b], before[a:b])
            skip = 0
            if fixed[k] is not None:
                path = tuple(np.concatenate(x) for x in zip(fixed[k], path))
                skip = len(fixed[k][1])
            paths[r].append((*path, starts[r][3]))
            own = late[a:b]
            # No more than `need` of these can be visited or be the threshold; a bound falls as `late` rises.
            best = np.argpartition(own, need - 1)[:need] if b - a > need else np.arange(b - a)
            left = -np.logaddexp(-starts[r][3], own[best])
            queues[r] += [(bound, len(paths[r]) - 1, skip + i, (int(edges[a + i]),)) for bound, i in zip(left.tolist(), best.tolist()) if bound > -np.inf]

    def _choose(self, paths: list, queues: list) -> dict:
        """Takes the region of the largest bound of each row: picks an edge in it and puts back what is left of it."""
        starts = {}
        for r, queue in enumerate(queues):
            if not queue:
                continue
            top = max(range(len(queue)), key=lambda i: queue[i][0])
            bound, p, step, gone = queue.pop(top)
            parts, edges, before, _ = paths[r][p]
            node = int(self.node[edges[step]])
            options = np.array([e for e in range(self.first[node], self.first[node + 1]) if e not in gone])
            shares = np.exp(self.log[options])
            u, wait = (float(self._uniform(np.array([r]), np.array([step]), 7 + 2 * len(paths[r]) + k)[0]) for k in (0, 1))
            chosen = int(options[min(np.searchsorted(np.cumsum(shares), u * shares.sum(), side="right"), len(options) - 1)])
            rest = shares.sum() - np.exp(self.log[chosen])
            if len(options) > 1 and rest > 0:
                mass = before[step] + np.log(rest)
                queue.append((float(-np.logaddexp(-bound, np.log(-np.log(wait)) - mass)), p, step, (*gone, chosen)))
            prefix = (parts[:step + 1], np.append(edges[:step], np.int32(chosen)), before[:step + 1])
            target, part = int(self.target[chosen]), int(parts[step])
            starts[r] = (prefix, part, target, bound)
        return starts

    def ids(self, edges: np.ndarray, byte_ids: np.ndarray) -> np.ndarray:
        return self.ids_and_sizes(edges, byte_ids)[0]

    def ids_and_sizes(self, edges: np.ndarray, byte_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids along edges, and how many each edge gave: a character that no piece covers gives those of its bytes."""
        found = self.piece[edges]
        code = -1 - found
        size = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        ids = np.repeat(found, size)
        begin = np.cumsum(size) - size
        raw = np.flatnonzero(code >= 0)
        for n in (1, 2, 3, 4):
            at = raw[size[raw] == n]
            for k in range(n if len(at) else 0):
                bits = code[at] >> (6 * (n - 1 - k))
                byte = (bits | (0, 0, 0xC0, 0xE0, 0xF0)[n] if n > 1 else bits) if k == 0 else 0x80 | (bits & 0x3F)
                ids[begin[at] + k] = byte_ids[byte & 0xFF]
        return ids.astype(np.int32), size


SAMPLE_TYPE = "array<struct<ids:array<int>,log_prob:double,log_inclusion:double>>"


def encode(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", samples: int = SAMPLES,
           seed: int = 0, name: str = "segmentations", model_path: str = MODEL_PATH, alpha: float = ALPHA,
           read_back: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """All rows and columns of ``docs`` with up to ``samples`` distinct segmentations added.

    Each has the piece ids, its log-probability and its log inclusion score: the log of the probability that
    its perturbed log-probability exceeds the largest one left out (0 when none is left).
    They come in the order of the perturbed log-probabilities.  A text with fewer segmentations gives them all; a
    null text gives null, an empty one a single empty segmentation.  The draw depends on the row key and ``seed`` only,
    so that repeated rows draw alike; a null key counts as 0.  ``read_back`` names a column that tells
    whether all segmentations decode to the text (null for a null text).  A task works on ``chunk`` text bytes at once,
    which bounds its memory and changes no result.
    """
    names = [unused(docs, name)] + ([unused(docs, read_back)] if read_back else [])
    place, key = docs.columns.index(text_column), docs.columns.index(id_column)
    held = sent(docs.sparkSession, Vocabulary.load(model_path, alpha))

    def work(batches):
        vocabulary = received(held)
        spellings = pa.array(vocabulary.decoded, pa.large_binary())
        for batch in batches:
            # Slices go out one by one: a batch of long texts with all its ids would be large.
            for a, b in slices(batch.column(place), chunk):
                yield encoded(batch.slice(a, b - a), vocabulary, spellings)

    def encoded(batch, vocabulary, spellings):
        text = batch.column(place)
        keys = np.array([hash_of(k) for k in batch.column(key).to_pylist()], dtype=np.uint64)
        seeds = mixed(keys ^ np.uint64((seed * 0xA0761D6478BD642F) & (2 ** 64 - 1)))
        texts = text.to_pylist()
        search = Search(vocabulary, [t or "" for t in texts], seeds, samples)
        results = [[(np.zeros(0, np.int64), 0.0, 0.0)] if t == "" else [] if t is None else found for t, found in zip(texts, search.run())]
        rows = np.cumsum([0, *map(len, results)])
        edges, logs, scores = (list(x) for x in zip(*(f for found in results for f in found))) if rows[-1] else ([], [], [])
        flat, sizes = search.ids_and_sizes(np.concatenate(edges) if edges else np.zeros(0, np.int64), vocabulary.byte_ids)
        owners = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum([0, *map(len, edges)])]
        restored = [None if t is None else True for t in texts]
        if read_back:
            told, at = spelled(flat, owners, spellings)
            for i, t in enumerate(texts):
                if t is not None:
                    whole = b" " + t.encode() if t else b""
                    restored[i] = all(bytes(told[at[j]:at[j + 1]]) == whole for j in range(rows[i], rows[i + 1]))
        ids = pa.ListArray.from_arrays(pa.array(owners, pa.int32()), pa.array(flat))
        items = pa.StructArray.from_arrays([ids, pa.array(logs, pa.float64()), pa.array(scores, pa.float64())], ["ids", "log_prob", "log_inclusion"])
        offsets = pa.array(rows.astype(np.int32), pa.int32(), mask=np.append(np.asarray(text.is_null()), False))
        arrays = [*batch.columns, pa.ListArray.from_arrays(offsets, items)] + ([pa.array(restored, pa.bool_())] if read_back else [])
        return pa.RecordBatch.from_arrays(arrays, [f"c{i}" for i in range(len(arrays))])

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    kinds = [f.dataType.simpleString() for f in docs.schema] + [SAMPLE_TYPE, "boolean"][:len(names)]
    return map_arrow(plain, work, ", ".join(f"c{i} {k}" for i, k in enumerate(kinds))).toDF(*docs.columns, *names)


def hash_of(key) -> int:
    if key is None:
        return 0
    if isinstance(key, int):
        return key & (2 ** 64 - 1)
    import hashlib
    return int.from_bytes(hashlib.blake2b(str(key).encode(), digest_size=8).digest(), "little")


def spelled(ids: np.ndarray, cuts: np.ndarray, spellings: pa.Array) -> tuple[memoryview, list[int]]:
    """The bytes of all piece ids in a row, and where those of each stretch between ``cuts`` begin."""
    _, offsets, data = spellings.take(pa.array(ids)).buffers()
    return memoryview(data or b""), np.frombuffer(offsets, dtype=np.int64)[cuts].tolist()


def decoded(ids: np.ndarray, pieces: list) -> str:
    """The text of piece ids: bytes joined, without the blank put before the text."""
    return b"".join([pieces[i] for i in ids.tolist()]).decode(errors="replace")[1:]


def decode(encoded: DataFrame, samples_column: str = "segmentations", name: str = "texts", model_path: str = MODEL_PATH) -> DataFrame:
    """All rows and columns with the decoded text of each segmentation added as an array (null where there is none)."""
    name = unused(encoded, name)
    place = encoded.columns.index(samples_column)
    held = sent(encoded.sparkSession, Vocabulary.load(model_path))

    def work(batches):
        pieces = received(held).decoded
        for batch in batches:
            texts = [[decoded(np.asarray(x["ids"].values), pieces) if len(x["ids"].values) else "" for x in row.values] if row.is_valid else None
                     for row in batch.column(place)]
            arrays = [*batch.columns, pa.array(texts, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, [f"c{i}" for i in range(len(arrays))])

    plain = encoded.toDF(*[f"c{i}" for i in range(len(encoded.columns))])
    kinds = [f.dataType.simpleString() for f in encoded.schema] + ["array<string>"]
    return map_arrow(plain, work, ", ".join(f"c{i} {k}" for i, k in enumerate(kinds))).toDF(*encoded.columns, name)
