"""What the quality classifier sends to the driver."""

import numpy as np
from pyspark.sql import types as T

from tremor.llm import quality

TEXTS = ["The cat sat on the mat and the dog was in the house with a ball for the man.",
         "You pathetic idiot, you are scum and a moron, that is what you are to me.", "$$$$ #### %%%%", "", None]


def test_sample_arrives_packed_and_trains_on_every_feature(spark, monkeypatch):
    sent, trained = [], []

    def map_rows(df, start, schema, f=quality.map_rows):
        sent.append(schema)
        return f(df, start, schema)

    def fit_scorer(rows, times=None):
        trained.append(sorted((r[0].tolist(), r[1].tolist(), n) for r, n in zip(rows, times)))
    monkeypatch.setattr(quality, "map_rows", map_rows)
    monkeypatch.setattr(quality, "fit_scorer", fit_scorer)
    rows = [(i, t) for i, t in enumerate(TEXTS + TEXTS[:1])]
    # one id: its two rows with the first text are one of the sample
    docs = spark.createDataFrame([(0 if t == TEXTS[0] else i, t) for i, t in rows], "doc_id long, text string")
    quality.fit(docs)
    assert not [f.name for s in sent for f in s.fields if isinstance(f.dataType, T.ArrayType)]
    for got, made, vote in zip(trained, (quality.features, quality.clean_features),
                               (quality.votes, quality.clean_votes)):
        seen = [(quality.shape(t), 2 if t == TEXTS[0] else 1) for t in TEXTS]
        want = [(*made(s), n) for s, n in seen if set(vote(s)) != {"-"}]
        assert got == sorted((at.tolist(), x.astype(np.float32).astype(float).tolist(), n) for at, x, n in want)
