"""The toxicity machine: its sample, its terms and its pairwise sums."""

import inspect
import zlib

import numpy as np
from pyspark.sql import functions as F

from playgraph.llm import toxicity
from playgraph.llm.toxicity import held_out, train_toxicity


def test_training_sample_is_16000_rows(spark):
    """A word told apart by the rows beyond the first 8,000 of the sample only is learned."""
    assert inspect.signature(train_toxicity).parameters["sample_rows"].default == 16_000
    ids = spark.range(30_000).where(~held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id").limit(16_000)
    order = [r.id for r in ids.collect()]
    rows = [(i, "late word" if n >= 8_000 and n % 2 else "plain word", int(n >= 8_000 and n % 2)) for n, i in enumerate(order)]
    t = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    fm = train_toxicity(t.select("doc_id", "text"), t.select("doc_id", "toxic"))
    assert zlib.crc32(b"late") % toxicity.SPACE in set(fm.terms)


def test_screen_by_blocks_equals_whole_counts():
    rng = np.random.default_rng(3)
    docs = [np.unique(rng.integers(0, 400, rng.integers(0, 60))).astype("<i4") for _ in range(2500)]
    labels = np.array([float(7 in d) for d in docs])
    fm = toxicity.fit_machine(docs, labels, epochs=1)
    share, want = labels.mean(), []
    for t in range(400):
        n = sum(t in d for d in docs)
        k = sum(labels[i] for i, d in enumerate(docs) if t in d)
        part = [x * np.log(x / (n * s)) for x, s in ((k, share), (n - k, 1 - share)) if x]
        want += [t] if 2 * sum(part) >= 20 else []
    assert list(fm.terms) == want and 7 in want


def test_scores_are_the_sum_over_all_pairs():
    """The machine's shortcut against a plain loop over term pairs."""
    rng = np.random.default_rng(1)
    fm = toxicity.FactorizationMachine(np.arange(30), 0.3, rng.normal(size=30), rng.normal(size=(30, 4)))
    docs = [np.sort(rng.choice(30, rng.integers(0, 12), replace=False)) for _ in range(50)]
    rows, cols = np.repeat(np.arange(50), [len(d) for d in docs]), np.concatenate(docs)
    got, _ = fm.raw(rows, cols, 50)
    for d, x in zip(docs, got):
        want = fm.w0 + sum(fm.w[i] for i in d) + sum(float(fm.v[i] @ fm.v[j]) for a, i in enumerate(d) for j in d[a + 1 :])
        assert abs(x - want) < 1e-9


def _fit_and_score(docs, labels):
    fm = toxicity.fit_machine(docs, labels)
    cols = [np.searchsorted(fm.terms, d[np.isin(d, fm.terms)]) for d in docs]
    rows = np.repeat(np.arange(len(docs)), [len(c) for c in cols])
    return fm, toxicity._sigmoid(fm.raw(rows, np.concatenate(cols).astype(np.int64), len(docs))[0])


def test_exclusive_words_are_learned():
    """Toxic exactly when one of two words occurs without the other: neither tells anything by itself."""
    rng = np.random.default_rng(5)
    docs, labels = [], []
    for _ in range(16_000):
        a, b = rng.random(2) < 0.5
        docs.append(np.unique(np.r_[rng.integers(10, 300, 15), [1] * int(a), [2] * int(b)]).astype("<i4"))
        labels.append(float(a != b))
    fm, score = _fit_and_score(docs, np.array(labels))
    assert {1, 2} <= set(fm.terms.tolist())
    assert np.mean((score >= 0.5) == np.array(labels)) > 0.99


def test_a_neutral_mention_is_toxic_beside_an_insult():
    """The mention is as frequent in clean as in toxic texts; only the pair tells."""
    rng = np.random.default_rng(6)
    docs, labels = [], []
    for _ in range(16_000):
        insult, mention = rng.random() < 0.2, rng.random() < 0.3
        docs.append(np.unique(np.r_[rng.integers(10, 500, 20), [1] * int(insult), [2] * int(mention)]).astype("<i4"))
        labels.append(float(insult and mention) if rng.random() < 0.98 else float(rng.random() < 0.06))
    fm, score = _fit_and_score(docs, np.array(labels))
    pair = np.array([1 in d and 2 in d for d in docs])
    one = np.array([(1 in d) != (2 in d) for d in docs])
    assert {1, 2} <= set(fm.terms.tolist()) and (score[pair] > 0.5).mean() > 0.99 and (score[one] < 0.5).mean() > 0.99


def test_pair_screen_counts():
    rng = np.random.default_rng(7)
    docs = [np.unique(rng.integers(0, 12, rng.integers(0, 8))).astype("<i4") for _ in range(400)]
    labels = np.array([float((3 in d) != (4 in d)) for d in docs])
    terms = np.arange(12)

    def ratio(k, n, s):
        return 2 * sum(x * np.log(x / y) for x, y in ((k, n * s), (n - k, n * (1 - s))) if x and y)

    want = []
    for t in terms:
        best = 0.0
        for other in terms:
            base = [i for i, d in enumerate(docs) if other in d]
            s = np.mean(labels[base])
            parts = [[i for i in base if (t in docs[i]) == x] for x in (True, False)]
            best = max(best, sum(ratio(labels[p].sum(), len(p), s) for p in parts))
        want.append(best >= 40)
    assert toxicity.paired_terms(docs, labels, terms, 40.0).tolist() == want and want[3] and want[4]


def test_terms_counted_by_spark_give_the_same_machine(spark, monkeypatch):
    """Only terms that the machine may keep are fetched; the machine is that of the whole sample."""
    rng = np.random.default_rng(8)
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(500)]
    rows = []
    for i in range(1500):
        text = " ".join(rng.choice(words, rng.integers(0, 30)))
        rows.append((i, text, int("wordaa" in text or "wordbb" in text)))
    t = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(5)
    monkeypatch.setattr(toxicity, "OFTEN", 10)
    seen = []
    real = toxicity.fit_machine
    monkeypatch.setattr(toxicity, "fit_machine", lambda docs, labels: seen.append((docs, labels)) or real(docs, labels, pair_terms=10))
    monkeypatch.setattr(toxicity._telling_terms, "__defaults__", (20.0, 10))
    fm = train_toxicity(t.select("doc_id", "text"), t.select("doc_id", "toxic"))
    kept = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    whole = list(toxicity._distinct_terms([r[1] for r in kept], {}))
    want = real(whole, np.array([float(r[2]) for r in kept]), pair_terms=10)
    assert fm.terms.tolist() == want.terms.tolist() and np.allclose(fm.w, want.w) and np.allclose(fm.v, want.v)
    assert sum(map(len, seen[0][0])) < sum(map(len, whole)) / 3
