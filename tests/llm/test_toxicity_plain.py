"""The toxicity model's choice of features, folds, pseudo-labels and threshold against a plain version on a whole table."""

import hashlib
import re
from statistics import median

import numpy as np

from loomtext.llm import toxicity as tox


def plain_features(text):
    words = set(re.findall(r"\w+", (text or "").lower()))
    return words | {w[:n] + "-" for w in words for n in tox.PREFIXES if len(w) > n}


def plain_model(texts, labels):
    sample = {}
    for doc, bad in labels:
        if doc in texts and bad is not None:
            key = hashlib.md5((texts[doc] or "").encode()).hexdigest()
            sample[key] = (max(int(bad == 1), sample.get(key, (0, ""))[0]), texts[doc])
    rows = [(key, bad, int(key[:4], 16) % tox.FOLDS, plain_features(text)) for key, (bad, text) in sorted(sample.items())]
    everywhere = {f: sum(f in r[3] for r in rows) for f in set().union(*[r[3] for r in rows])}

    def chosen(without=None, only_up=False):
        used = [r for r in rows if r[2] != without]
        p = sum(r[1] for r in used) / len(used)
        out = set()
        for f in (f for f, n in everywhere.items() if n >= tox.MIN_DOCUMENTS):
            bad, seen = sum(r[1] for r in used if f in r[3]), sum(f in r[3] for r in used)
            above = bad - seen * p
            if seen >= tox.MIN_DOCUMENTS and (above if only_up else abs(above)) > tox.BEYOND_CHANCE * (seen * p * (1 - p)) ** 0.5:
                out.add(f)
        return out

    grades = [r[1] for r in rows]
    for k in range(tox.FOLDS):
        up = chosen(k, True)
        own = {i: len(r[3] & up) for i, r in enumerate(rows) if r[2] == k and r[1]}
        for i, n in own.items():
            grades[i] += n >= max(1, median(own.values()))

    def fitted(use, names):
        place = {f: i for i, f in enumerate(sorted(names))}
        pairs = [(n, place[f]) for n, i in enumerate(use) for f in sorted(rows[i][3] & names)]
        w, t = tox.fit_cumulative_link(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]), np.array([grades[i] for i in use]), len(names))
        return {f: w[i] for f, i in place.items()}, t

    w, t = fitted([i for i, r in enumerate(rows) if r[2] != 0], chosen(0))
    held = sorted(((1 / (1 + np.exp(t[0] - sum(w[f] for f in r[3] & w.keys()))), r[1]) for r in rows if r[2] == 0), key=lambda x: -x[0])
    asked = tox.CLEAN_COST / (1 + tox.CLEAN_COST)
    gains = [(sum(1.0 if bad else -tox.CLEAN_COST for _, bad in held[: i + 1]), held[i][0], held[i + 1][0] if i + 1 < len(held) else 0.0) for i in range(len(held))]
    best = max(g for g, _, _ in gains)
    cuts = [min(max(asked, np.nextafter(low, 1)), p) for g, p, low in gains if low < p and g > 0 and g >= best - tox.CLEAN_COST]
    reject = min(cuts, key=lambda c: abs(c - asked)) if cuts else 2.0
    return *fitted(range(len(rows)), chosen()), reject, grades


def test_model_equals_the_plain_one(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    weights, thresholds, reject, grades = plain_model(texts, [(r["doc_id"], r["toxic"]) for r in labels.collect()])
    model = tox.train(docs, labels)
    assert model.weights.keys() == weights.keys() and len(weights) > 5 and set(grades) == {0, 1, 2}
    assert all(abs(model.weights[f] - w) < 1e-6 for f, w in weights.items())
    assert np.allclose(model.thresholds, thresholds, atol=1e-6) and abs(model.reject_at - reject) < 1e-6
    got = {r["doc_id"]: r for r in tox.score_toxicity(docs, model).collect()}
    for doc, text in texts.items():
        p = 1 / (1 + np.exp(-np.clip(sum(weights[f] for f in plain_features(text) & weights.keys()) - thresholds, -35, 35)))
        assert abs(got[doc]["p_toxic"] - p[0]) < 1e-6 and abs(got[doc]["p_severe"] - p[1]) < 1e-6
        assert abs(p[0] - reject) < 1e-6 or got[doc]["toxic"] == (p[0] >= reject)
