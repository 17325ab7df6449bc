"""Language ID works on parts of bounded size, and carries a text once."""

import numpy as np

from wavequill.llm import language_id

TEXTS = ["the cat sat on the mat", "der hund liegt im garten", None, "...", "a", "le chat dort", "the dog " * 30]


def test_parts_change_nothing(spark, monkeypatch):
    rows = [(i, t, "en" if i % 2 else "de") for i, t in enumerate(TEXTS * 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    models = language_id.train(docs)
    want, sizes = models.entropies(TEXTS)
    found = {r.doc_id: (r.lang_pred, r.score, r.rejected) for r in language_id.identify(docs, models).collect()}
    monkeypatch.setattr(language_id, "PART", 40)
    got, again = models.entropies(TEXTS)
    assert np.array_equal(want, got, equal_nan=True) and np.array_equal(sizes, again)
    carried = language_id.identify(docs, models, carry=True)
    assert {r.doc_id: (r.lang_pred, r.score, r.rejected) for r in carried.collect()} == found
    assert {r.doc_id: r.row.text for r in carried.collect()} == {i: t for i, t, _ in rows}
    small = language_id.train(docs)
    assert small.langs == models.langs and np.array_equal(small.entropies(TEXTS)[0], want, equal_nan=True)
