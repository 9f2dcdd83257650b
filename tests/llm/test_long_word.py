"""Draws along a word of very many pieces."""

import numpy as np

from loanloom.llm import pieces


def test_draws_of_a_long_word_share_no_numbers(monkeypatch):
    drawn, plain = [], pieces.Search._uniform

    def noted(self, row, place, salt):
        drawn.append(np.column_stack([row, place, np.full(len(row), salt)]))
        return plain(self, row, place, salt)

    monkeypatch.setattr(pieces.Search, "_uniform", noted)
    rng = np.random.default_rng(5)
    word = "".join(chr(97 + x) for x in rng.integers(0, 26, 30_000))
    search = pieces.Search(pieces.Vocabulary.load(), [word], np.array([7], dtype=np.uint64), 3)
    found = search.run()[0]
    assert len(found) == 3 and all(len(edges) > 4096 for edges, _, _ in found)
    assert len({edges.tobytes() for edges, _, _ in found}) == 3
    keys = np.concatenate(drawn)
    assert len(np.unique(keys, axis=0)) == len(keys)
