"""The first weights of op8 are those that fit all training words."""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarry.llm import common as C
from quarry.llm import lm_score as L


def slope_over_all(counts, ends, weights):
    """Of the mean log-probability of all words by each weight, less the pull to where fitting begins."""
    words, n = list(counts), np.array(list(counts.values()), float)
    data, at = C.text_buffers(pa.array(words))
    d = L.decisions(data, at[:-1], at[1:])
    times = np.repeat(np.append(n, ends), np.diff(d.first))  # the end symbol is in the tables, too
    pairs = np.zeros((L.PREDICTORS, L.SLOTS, 2))
    for o, slot in enumerate(d.slots):
        np.add.at(pairs[o], (slot, d.turn), times)
    keep = slice(0, d.first[-2])
    x = np.stack([np.log(np.maximum(pairs[o, s, d.turn] - 1, 0) + L.PRIOR) - np.log(pairs[o, s, 1 - d.turn] + L.PRIOR) for o, s in enumerate(d.slots)])[:, keep]
    gate, times = d.gate[keep], times[keep]
    out = np.zeros_like(weights)
    for g in range(L.GATES):
        own = gate == g
        missed = 1 / (1 + np.exp(weights[:, g] @ x[:, own]))
        out[:, g] = x[:, own] @ (times[own] * missed) / times[own].sum() - 1e-3 * (weights[:, g] - L.FIRST_WEIGHT)
    return out


def test_all_words_count(spark, monkeypatch):
    """9,000 different words, which is more than were looked at before; the parts don't matter."""
    rng = np.random.default_rng(5)
    letters, weights = "etaonirshldcumfp", 1 / np.arange(1, 17)
    words = ["".join(rng.choice(list(letters), rng.integers(3, 10), p=weights / weights.sum())) for _ in range(9_000)]
    text = [" ".join(rng.choice(words, 200)) for _ in range(100)] + [" ".join(words[i : i + 300]) for i in range(0, len(words), 300)]
    kept, learned = [], L._learned
    monkeypatch.setattr(L, "_learned", lambda *a: kept.append(learned(*a)) or kept[-1])
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string").repartition(3)
    for part_bytes in (1 << 14, 1 << 20):
        L.score(docs, F.lit(True), part_bytes=part_bytes)
    counts = Counter(w for t in text for w in t.split())
    assert len(counts) > 4096
    for model in kept:
        assert np.abs(slope_over_all(counts, len(text), model.first)).max() < 2e-5
    assert np.allclose(kept[0].first, kept[1].first, atol=1e-5)


def test_no_training_words(spark, monkeypatch):
    kept, learned = [], L._learned
    monkeypatch.setattr(L, "_learned", lambda *a: kept.append(learned(*a)) or kept[-1])
    L.score(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), F.lit(False))
    assert (kept[0].first == L.FIRST_WEIGHT).all()
