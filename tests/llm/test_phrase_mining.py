"""Phrase counts, their closure over further passes and collocation scores against plain Python."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from playgraph.llm import phrase_mining as pm

SCHEMA = "doc_id bigint, text string, lang string, a int, words int"


def _rows(seed=1, n=150):
    rng = random.Random(seed)
    vocab = ["Of", "the", "a", "in", "House", "straße", "日本", "x-y", "it's"] + ["w%d" % i for i in range(30)]
    fixed = ["the state of the art", "In the House of", "a a a a", "straße 日本 it's x-y w1", "w1 w2"]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choices(vocab, weights=[9] * 9 + [1] * 30, k=rng.randint(0, 12))) if rng.random() < 0.5 else rng.choice(fixed) for _ in range(rng.randint(1, 10))]
        text = "".join(p + rng.choice([". ", " ", "\t", "\n", "\r\n", "? ", ",", ";\x0b", " : "]) for p in parts)
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(900, None, "en"), (901, "", "de"), (902, " \t.\n", "en"), (903, "W1", "fr"), rows[3], rows[3], (None, rows[5][1], "en"), (904, "the state of the art. " * 3000, "de"), (905, "q" * 20000, "en")]


def _counts(rows):
    f, n = collections.Counter(), collections.Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", t):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    return f, n


def _brute(rows, least, top=2000, absorbed=100):
    f, n = _counts(rows)
    found = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    inside = collections.defaultdict(int)
    for (lang, p), v in found.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inside[lang, p[i : i + k]] = max(inside[lang, p[i : i + k]], v)
    out = collections.defaultdict(list)
    for (lang, p), a in found.items():
        if 100 * inside[lang, p] >= absorbed * a:
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    rows = []
    for lang, found in out.items():
        rows += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(rows)


# Full sample; hardly any sample, so that words, pairs and longer phrases all need further passes; a table so small that strangers say yes.
@pytest.mark.parametrize("sample,bits,least,top", [(100.0, 20, 20, 2000), (1.0, 20, 20, 15), (30.0, 8, 8, 2000)])
def test_against_brute_force(spark, monkeypatch, sample, bits, least, top):
    rows = _rows()
    passes = []
    counted = pm._counted
    monkeypatch.setattr(pm, "_counted", lambda *a: passes.append(1) or counted(*a))
    docs = spark.createDataFrame([(i, t, x, 1, 2) for i, t, x in rows], SCHEMA).repartition(4)
    got = pm.collocations(docs, least=least, top=top, sample_percent=sample, bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == _brute(rows, least, top)
    assert len(passes) >= (2 if sample == 1.0 else 1) and len(passes) <= 6


def test_frequent_phrases_are_all_found(spark):
    rows = _rows(4)
    docs = spark.createDataFrame([(i, t, x, 1, 2) for i, t, x in rows], SCHEMA)
    got = pm.frequent_phrases(docs, least=15, sample_percent=2.0, bits=12)
    f, n = _counts(rows)
    want = [(lang, " ".join(p), len(p), v) for (lang, p), v in f.items() if v >= 15] + [(lang, "", 0, v) for lang, v in n.items() if v]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_absorbed_share(spark):
    """A lower share absorbs more phrases."""
    rows = _rows(6)
    docs = spark.createDataFrame([(i, t, x, 1, 2) for i, t, x in rows], SCHEMA)
    got = pm.collocations(docs, least=10, absorbed=60)
    assert sorted(map(tuple, got.collect())) == _brute(rows, 10, absorbed=60)


def test_slices_and_long_texts(monkeypatch):
    """Cutting a long text where a piece ends loses no phrase."""
    monkeypatch.setattr(pm, "SLICE", 50)
    text = "the state of the art. in a house, " * 30
    found = collections.Counter()
    table = pm.BitTable(8, np.full(4, 2**64 - 1, np.uint64))
    for _, data, starts in pm._slices(pa.array([text, None, "a b"], pa.string()), ["en"] * 3):
        for n, _, counts, words, places in pm.slice_phrases(data, starts, 5, table, None, 5):
            for p, c in zip(pm._phrase_bytes(words, places).to_pylist(), counts.tolist()):
                found[tuple(p.decode().split(" "))] += c
    f, _ = _counts([(1, text, "en"), (2, "a b", "en")])
    assert dict(found) == {p: v for (_, p), v in f.items()}


def test_phrase_hashes_agree():
    """The hash of a phrase from its text is that of the pass."""
    data = np.frombuffer("aa b\tüü cc dd".encode(), np.uint8)
    table = pm.BitTable(8, np.full(4, 2**64 - 1, np.uint64))
    for _, hashes, _, words, places in pm.slice_phrases(data, np.zeros(1, np.int64), 5, table, None, 5):
        names = [p.decode() for p in pm._phrase_bytes(words, places).to_pylist()]
        assert pm._phrase_hashes(names).tolist() == hashes.tolist()


def test_large_products(spark):
    """Products beyond 64 bits keep all digits."""
    one = "(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    a, n, l, r = 123_456_789_012, 9_876_543_210_987_654, 987_654_321_098, 123_456_789_055
    assert spark.sql(f"SELECT {one} AS s FROM (SELECT {a}L a, {n}L n, {l}L l, {r}L r)").first().s == 1000 * a * n // (l * r)


def test_empty_table(spark):
    assert pm.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
