"""Rows that share an id with other texts or vectors: none is lost."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from playgraph.llm import suffix_dups, topk
from playgraph.llm.minhash_dups import near_documents
from playgraph.llm.topk import exact_top_k

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
A = " ".join(f"alpha{i}" for i in range(60))
B = " ".join(f"beta{i}" for i in range(60))
NEAR_B = B.replace("beta59", "other")
UNIQUE = " ".join(f"solo{i}" for i in range(60))


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS).repartition(3)


def test_links_of_every_class_of_an_id_are_found(spark):
    """Id 5 has two texts; 9 equals the second, 11 is near it: all are one component."""
    docs = _docs(spark, [(5, A, "s"), (5, B, "s"), (9, B, "s"), (11, NEAR_B, "s"), (20, A, "s"), (30, UNIQUE, "s")])
    got = {(r.doc_id, r.component_id, r.kept) for r in near_documents(docs).collect()}
    assert got == {(5, 5, True), (9, 5, False), (11, 5, False), (20, 5, False), (30, 30, True)}
    # By text, the two texts of id 5 are documents of their own.
    apart = {(r.doc_id, r.component_id) for r in near_documents(docs, by_text=True).collect()}
    assert apart == {(5, 5), (9, 5), (11, 5), (20, 5), (30, 30)}


def test_the_stage_drops_texts_not_ids(spark, tmp_path):
    rows = [(3, B, "s"), (7, NEAR_B, "s"), (7, UNIQUE, "s"), (8, A, "b"), (8, A, "a"), (None, A, "s"), (None, A, "s"), (9, None, "s"), (9, None, "s"), (10, "", "s")]
    kept = corpus_pipeline.minhash_dedup(spark, _docs(spark, rows), str(tmp_path))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = sorted(((r.doc_id, r.text, r.source) for r in kept.collect()), key=str)
    assert got == sorted([(3, B, "s"), (7, UNIQUE, "s"), (8, A, "a"), (None, A, "s"), (None, A, "s"), (9, None, "s"), (10, "", "s")], key=str)


def test_the_stage_beyond_the_broadcast_size(spark, tmp_path, monkeypatch):
    rows = [(i, t, "s") for i, t in enumerate([A, A, B, NEAR_B, UNIQUE])] + [(2, B, "s")]
    want = sorted((r.doc_id, r.text) for r in corpus_pipeline.minhash_dedup(spark, _docs(spark, rows), str(tmp_path)).collect())
    monkeypatch.setattr(corpus_pipeline, "FEW_IDS", -1)
    assert sorted((r.doc_id, r.text) for r in corpus_pipeline.minhash_dedup(spark, _docs(spark, rows), str(tmp_path)).collect()) == want == [(0, A), (2, B), (4, UNIQUE)]


VEC = "vec_id bigint, embedding array<double>"


def test_every_row_of_an_id_is_a_candidate(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [1.0]), (1, [2.0]), (2, [-1.0])], VEC)
    got = sorted(tuple(r) for r in exact_top_k(df, F.col("vec_id") == 0).collect())
    assert got == [(0, 1, 1, 131072), (0, 2, 1, 65536), (0, 3, 2, -65536)]
    # A query id with two vectors asks twice; each is the other's candidate.
    got = sorted(tuple(r) for r in exact_top_k(df, F.col("vec_id") == 1, k=2).collect())
    assert got == [(1, 1, 0, 131072), (1, 1, 1, 131072), (1, 2, 0, 65536), (1, 2, 1, 131072)]


@pytest.mark.parametrize("tiles", [1, 32])
def test_histograms_over_many_tiles(spark, monkeypatch, tiles):
    monkeypatch.setattr(topk, "TILE", 16)
    monkeypatch.setattr(topk, "HELD_TILES", tiles)
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=6).tolist()) for i in range(300)]
    got = sorted(tuple(r) for r in exact_top_k(spark.createDataFrame(rows, VEC), F.col("vec_id") % 5 == 0, bins=4).collect())
    ints = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows}
    want = []
    for q in range(0, 300, 5):
        best = sorted((-int(ints[q] @ ints[i]), i) for i in ints if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_scores_beyond_64_bits_are_refused(spark):
    df = spark.createDataFrame([(0, [1e12, 1.0]), (1, [1e12, 1.0])], VEC)
    with pytest.raises(Exception, match="64 bits"):
        exact_top_k(df, F.col("vec_id") == 0).collect()
    fits = spark.createDataFrame([(0, [1e6]), (1, [-1e6])], VEC)
    assert math.isclose(exact_top_k(fits, F.col("vec_id") == 0).first().score, -(256e6**2))


def test_windows_of_equal_hashes_are_told_apart_by_bytes(spark, monkeypatch):
    """With a window hash that knows 8 values only, the result is still that of the bytes."""
    rng = np.random.default_rng(9)
    base = ["".join(rng.choice(list("abcdefgh "), 400)) for _ in range(6)]
    rows = []
    for i in range(60):
        a, b = rng.choice(6, 2)
        cut = int(rng.integers(0, 250))
        rows.append((i, "".join(rng.choice(list("xyz "), 30)) + base[a][cut : cut + 140] + "".join(rng.choice(list("uvw "), 20)) + base[b][: 100 + cut % 90], "s"))
    docs = _docs(spark, rows)

    def removed():
        return sorted((r.doc_id, sorted(r.spans)) for r in suffix_dups.repeated_spans(docs).collect())

    want = removed()
    real = suffix_dups.window_hash
    monkeypatch.setattr(suffix_dups, "window_hash", lambda *a: real(*a) & np.uint64(7))
    assert removed() == want and len(want) > 30
