"""What the language operator does not accept."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from loanloom.llm import language
from loanloom.llm.frames import bucket_of, read_table

UNLEARNED = {
    "it": "Il governo ha annunciato ieri una serie di nuove misure economiche per aiutare le famiglie in difficoltà, mentre l'opposizione chiede "
          "interventi più rapidi e decisi. Secondo gli esperti, la situazione rimane delicata e bisogna attendere i prossimi mesi per capire se le "
          "riforme avranno gli effetti sperati. Nelle città più grandi i cittadini si lamentano dei prezzi troppo alti e degli stipendi fermi.",
    "pl": "Rząd ogłosił wczoraj szereg nowych środków gospodarczych, które mają pomóc rodzinom w trudnej sytuacji, podczas gdy opozycja domaga się "
          "szybszych i bardziej zdecydowanych działań. Zdaniem ekspertów sytuacja pozostaje trudna i trzeba poczekać kilka miesięcy na skutki.",
}


def test_unlearned_languages_are_rejected_and_held_out_rows_stay(spark):
    docs = read_table(spark, "/root/testdata/sf0.1", "documents")
    held = bucket_of(F.col("doc_id"), 5) == 0
    model = language.fit(docs.where(~held))
    texts = [x for t in UNLEARNED.values() for x in (t[:30], t[:120], t, t + " " + t, (t + " ") * 8)]
    assert not model.predict(pa.array(texts, pa.large_string()))[2].any()
    rows = language.identify(docs.where(held), model)[0].select("accepted", "text").collect()
    assert len(rows) > 1500 and np.mean([r["accepted"] for r in rows]) >= 0.995
    begun = [x for x in (r["text"][:40] for r in rows) if len(x) == 40]
    assert np.mean(model.predict(pa.array(begun, pa.large_string()))[2]) >= 0.97


def test_every_length_has_a_bound():
    totals = np.zeros((64, 500), dtype=np.int64)
    totals[3, 100] = 5
    assert (language.acceptance_floors(totals) > 0).all()
    totals[6, 300:400] = 10     # the lowest tenth are mislabelled or junk
    totals[6, 20] = 100
    floors = language.acceptance_floors(totals)
    assert floors[9] == floors[6] <= 0.36 * 0.8 and (floors > 0).all() and (np.diff(floors) >= 0).all()


def test_centroids_and_bounds_come_from_all_rows(spark, monkeypatch):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").where("text is not null and lang is not null")
    counted = []
    floors = language.acceptance_floors
    monkeypatch.setattr(language, "acceptance_floors", lambda totals: counted.append(int(totals.sum())) or floors(totals))
    small = language.fit(docs, sample=5)
    whole = language.fit(docs)
    assert counted[0] == counted[1] >= docs.count()
    # With one centroid each it is the mean of all rows of the language, whatever the sample that found its first centre.
    one = [language.fit(docs, centroids=1, sample=n) for n in (5, 800)]
    assert np.allclose(one[0].centroids, one[1].centroids, atol=1e-9)
    assert small.languages == whole.languages and (small.floors > 0).all()
    counts = np.array([[0.0, 3, 0, 1], [0, 0, 0, 0]])
    idf = np.array([1.0, 2, 3, 4])
    assert np.allclose(language.vectors(counts, idf), language.vectors(counts, idf, sparse=True))
