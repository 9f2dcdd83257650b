import tracemalloc

import numpy as np

import corpus_pipeline
from loanloom.llm import pieces
from loanloom.llm.frames import read_table


def test_a_smaller_chunk_draws_the_same(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text").limit(60).localCheckpoint()
    whole, small = (pieces.encode(docs, chunk=n).select("doc_id", "segmentations.ids") for n in (pieces.CHUNK, 1 << 11))
    assert whole.exceptAll(small).isEmpty() and small.exceptAll(whole).isEmpty()


def test_the_pipeline_segments_in_small_chunks():
    vocabulary, rng = pieces.Vocabulary.load(), np.random.default_rng(1)
    text = " ".join("".join(map(chr, rng.integers(97, 123, 5))) for _ in range(pieces.CHUNK // 6))

    def peak(size):
        tracemalloc.start()
        pieces.Search(vocabulary, [text[:size]], np.ones(1, np.uint64), 2).run()
        found = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return found

    assert peak(corpus_pipeline.PIECE_CHUNK) < 0.4 * peak(pieces.CHUNK)
