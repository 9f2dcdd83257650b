"""The work of a slice of texts: lattices laid out in layers, pieces spelled all at once."""

import numpy as np
import pyarrow as pa

from loanloom.llm import pieces


def test_nodes_lie_in_layers_by_their_distance_from_the_end():
    vocabulary, words = pieces.Vocabulary.load(), [" segment", "\n", " to", " é🎈", "  longer", " to"]
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.int32)
    sizes = np.array([len(w) for w in words])
    graph = pieces.Lattices(vocabulary, codes, sizes)
    layers = np.repeat(np.arange(1, sizes.max() + 1), [(sizes >= k).sum() for k in range(1, sizes.max() + 1)])
    assert (layers[graph.roots] == sizes).all() and len(set(graph.roots.tolist())) == len(words)
    # An edge leads as many layers down as its piece has characters.
    length = [1 if i < 0 else len(vocabulary.decoded[i].decode()) for i in graph.piece]
    down = layers[graph.node] - np.where(graph.target < 0, 0, layers[graph.target])
    assert down.tolist() == length and np.allclose(np.bincount(graph.node, np.exp(graph.log)), 1)
    # A part has the same edges with any others around it.
    for word, root in zip(words, graph.roots):
        one = pieces.Lattices(vocabulary, np.array([ord(c) for c in word], dtype=np.int32), np.array([len(word)]))
        a, b = (slice(*g.first[[r, r + 1]]) for g, r in ((graph, root), (one, one.roots[0])))
        assert (graph.piece[a] == one.piece[b]).all() and (graph.log[a] == one.log[b]).all()
        assert (graph.reach[a] - root == one.reach[b] - one.roots[0]).all()


def test_pieces_of_many_rows_are_spelled_at_once():
    spellings = pa.array([b"", b"a", b"bc", b"\xff"], pa.large_binary())
    told, at = pieces.spelled(np.array([2, 1, 3, 0], dtype=np.int32), np.array([0, 2, 2, 4]), spellings)
    assert [bytes(told[a:b]) for a, b in zip(at, at[1:])] == [b"bca", b"", b"\xff"]
    assert pieces.spelled(np.zeros(0, np.int32), np.array([0]), spellings)[1] == [0]


def test_bytes_that_are_no_text_are_not_taken_for_the_text(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a �"), (2, ""), (3, None)], "doc_id long, text string")
    load = pieces.Vocabulary.load

    def broken(*rest):
        vocabulary = load(*rest)
        # Every piece and byte above ASCII spells one byte that no text has.
        vocabulary.decoded = [b"\xff" if any(b > 0x7F for b in d) else d for d in vocabulary.decoded]
        return vocabulary

    monkeypatch.setattr(pieces.Vocabulary, "load", staticmethod(broken))
    found = {r["doc_id"]: r["restored"] for r in pieces.encode(docs, read_back="restored").collect()}
    assert found == {1: False, 2: True, 3: None}
