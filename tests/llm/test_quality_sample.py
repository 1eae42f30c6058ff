"""The quality model's labelled sample: 2000 documents of a class, held as views of what was collected."""

from collections import Counter

import numpy as np

from trolley.llm import quality_model


def test_default_sample(spark, monkeypatch):
    n = 5600
    docs = spark.range(n).selectExpr("id as doc_id", "concat('w', id % 7) as text")
    labels = spark.range(n).selectExpr("id as doc_id", "int(id % 20 > 0) as quality", "0 as toxic")
    seen = []
    monkeypatch.setattr(quality_model, "train", lambda rows: seen.extend(rows))
    quality_model.fit(docs, labels)
    taken = Counter(r[2] for r in seen)
    assert taken[1] >= 2000 and 180 < taken[0] < 240
    assert all(r[1].dtype == np.float32 and not r[1].flags.owndata for r in seen)
