"""Scores of rows do not hang on the rows beside them."""

import numpy as np
import pyarrow as pa

from loanloom.llm import toxicity


def test_repeated_rows_score_alike_in_one_batch():
    forms, _ = toxicity.token_forms(pa.array(["scum"], pa.large_string()))
    model = toxicity.ToxicityModel(forms[0], np.array([6.0]), 1.0, 0.05)
    texts = ["scum"] * 4 + ["scum, said the scum"] * 3 + ["", None, "scum", "scum scum scum"]
    evidence = model.evidence(*toxicity.token_forms(pa.array(texts, pa.large_string())))
    alone = np.concatenate([model.evidence(*toxicity.token_forms(pa.array([t], pa.large_string()))) for t in texts])
    assert evidence.tolist() == alone.tolist()
    assert (evidence[:7] > 0).all() and len(set(evidence[:4])) == 1 and len(set(evidence[4:7])) == 1 and evidence[7] == evidence[8] == 0
    # Within a row a word said again at once counts nothing.
    assert model.passages(*toxicity.token_forms(pa.array(["scum scum scum"], pa.large_string())))[0].score == 6.0
