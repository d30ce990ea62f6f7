"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed terms: every letter run, and the first four
and five letters of longer ones.  The machine adds linear weights and pairwise
interactions of the terms present.  It is fitted on a bounded sample of the
labelled training rows (``sample_rows``, taken by a hash of the id), over the
terms that pass a likelihood-ratio screen of their own or matter beside another
term, by AdaGrad steps on the logistic loss.  Scoring reads whole texts where they lie, looks each
distinct chunk up once, and needs no shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import lean, release_memory, stored

SPACE = 1 << 26
#: Least likelihood ratio of a term, and the number of frequent terms looked at in pairs.
SCREEN, OFTEN = 20.0, 2000
RUN = re.compile(r"[^\W\d_]+")


def held_out(id_col: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(4)) == 2, F.lit(False))


def chunk_terms(chunk: str) -> list[int]:
    """Hashed terms of one space-separated chunk."""
    out = []
    for run in RUN.findall(chunk.lower()):
        names = [run] + [f"{run[:k]}*" for k in (4, 5) if len(run) > k]
        out += [zlib.crc32(x.encode()) % SPACE for x in names]
    return out


def _distinct_terms(texts, cache: dict, lookup=None, limit: int = 100_000):
    """For each text its sorted distinct terms (after ``lookup``) as int32, chunk by chunk through ``cache``."""
    for text in texts:
        chunks = set((text or "").replace("\n", " ").split(" "))
        if len(cache) > limit:
            cache.clear()
        for c in chunks:
            if c not in cache:
                terms = chunk_terms(c)
                cache[c] = np.asarray(terms if lookup is None else [lookup[t] for t in terms if t in lookup], dtype="<i4").tobytes()
        yield np.unique(np.frombuffer(b"".join(map(cache.__getitem__, chunks)), dtype="<i4"))


class FactorizationMachine:
    """score = sigmoid(w0 + sum w_i + sum over pairs of v_i . v_j) over the known terms present."""

    def __init__(self, terms: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.terms, self.w0, self.w, self.v = terms, w0, w, v

    def raw(self, rows: np.ndarray, cols: np.ndarray, n: int) -> tuple:
        """Scores before the sigmoid of n documents given as (row, term) pairs, and each row's factor sums."""
        linear = np.bincount(rows, self.w[cols], n)
        sums = np.stack([np.bincount(rows, self.v[cols, f], n) for f in range(self.v.shape[1])], 1) if self.v.shape[1] else np.zeros((n, 0))
        own = np.bincount(rows, (self.v[cols] ** 2).sum(1), n) if self.v.shape[1] else 0.0
        return self.w0 + linear + 0.5 * ((sums**2).sum(1) - own), sums


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _blocks(docs: list[np.ndarray], rows: int = 1000):
    """(slice of ``docs``, row inside it and term of every entry), a bounded number of documents at a time."""
    for a in range(0, len(docs), rows):
        part = docs[a : a + rows]
        yield slice(a, a + len(part)), np.repeat(np.arange(len(part)), [len(d) for d in part]), np.concatenate(part)


def _likelihood_ratio(k, n, share):
    """2 log likelihood ratio of k toxic ones among n against a share of toxic ones; 0 where undefined."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * (np.nan_to_num(k * np.log(k / (n * share)), posinf=0, neginf=0) + np.nan_to_num((n - k) * np.log((n - k) / (n * (1 - share))), posinf=0, neginf=0))


def paired_terms(docs: list[np.ndarray], labels: np.ndarray, terms: np.ndarray, screen: float, rows: int = 200) -> np.ndarray:
    """Which of ``terms`` matter beside another of them: among the documents that hold some other term, those
    with and those without this one differ in their share of toxic ones (likelihood ratio of at least ``screen``).

    So a group mention that is toxic beside an insult only, or a word that is toxic
    unless another one stands by it, is found though it means nothing alone.
    """
    m = len(terms)
    both, toxic = np.zeros((m, m), np.float32), np.zeros((m, m), np.float32)
    for part, r, t in _blocks(docs):
        at = np.searchsorted(terms, t)
        at[at == m] = 0
        known = terms[at] == t if m else np.zeros(len(t), bool)
        held = np.zeros((part.stop - part.start, m), np.float32)
        held[r[known], at[known]] = 1
        both += held.T @ held
        toxic += (held * labels[part, None].astype(np.float32)).T @ held
    found = np.zeros(m, bool)
    n, k = np.diag(both).astype(float), np.diag(toxic).astype(float)
    for a in range(0, m, rows):  # documents with term a, split by each other term
        n_with, k_with = both[a : a + rows].astype(float), toxic[a : a + rows].astype(float)
        n_all, k_all = n[a : a + rows, None], k[a : a + rows, None]
        share = k_all / np.maximum(n_all, 1)
        ratio = _likelihood_ratio(k_with, n_with, share) + _likelihood_ratio(k_all - k_with, n_all - n_with, share)
        found |= (ratio >= screen).any(0)
    return found


def fit_machine(docs: list[np.ndarray], labels: np.ndarray, factors: int = 4, epochs: int = 20, screen: float = SCREEN, seed: int = 7, pair_screen: float = 40.0, pair_terms: int = OFTEN) -> FactorizationMachine:
    """Fit on the term arrays of a sample.  No rows, or one class only: a constant score of that share.

    Terms stay that tell by themselves (``screen``) or, of the ``pair_terms`` in
    most documents, beside another one (``pair_screen``, higher, since pairs are many).
    """
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return FactorizationMachine(np.zeros(0, np.int64), 35.0 if share else -35.0, np.zeros(0), np.zeros((0, factors)))
    terms = np.unique(np.concatenate(docs))
    # Likelihood-ratio screen: terms whose share of toxic documents is no accident.
    # Counted block by block, so only the sample's four-byte terms are held at once.
    k, n = np.zeros(len(terms)), np.zeros(len(terms))
    for part, r, t in _blocks(docs):
        at = np.searchsorted(terms, t)
        k += np.bincount(at, labels[part][r], len(terms))
        n += np.bincount(at, minlength=len(terms))
    keep = _likelihood_ratio(k, n, share) >= screen
    often = np.sort(np.lexsort((terms, -n))[:pair_terms])
    keep[often[paired_terms(docs, labels, terms[often], pair_screen)]] = True
    alive = np.flatnonzero(keep)
    terms = terms[alive]
    row, col = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for part, r, t in _blocks(docs):
        known = np.isin(t, terms)
        row.append((part.start + r[known]).astype(np.int32))
        col.append(np.searchsorted(terms, t[known]).astype(np.int32))
    row, col = np.concatenate(row), np.concatenate(col)
    starts = np.searchsorted(row, np.arange(len(docs) + 1))
    rng = np.random.default_rng(seed)

    def batches():
        order = rng.permutation(len(docs))
        for a in range(0, len(order), 64):
            part = order[a : a + 64]
            picks = [np.arange(starts[i], starts[i + 1]) for i in part]
            r = np.repeat(np.arange(len(part)), [len(p) for p in picks])
            yield part, r, col[np.concatenate(picks)]

    fm = FactorizationMachine(terms.astype(np.int64), float(np.log(share / (1 - share))), np.zeros(len(alive)), rng.normal(0, 0.01, (len(alive), factors)))
    gw, gv, g0 = np.ones(len(alive)), np.ones((len(alive), factors)), 1.0
    for _ in range(epochs):
        for part, r, c in batches():
            x, sums = fm.raw(r, c, len(part))
            miss = _sigmoid(x) - labels[part]
            used, at = np.unique(c, return_inverse=True)
            grad_w = np.bincount(at, miss[r], len(used)) + 1e-3 * fm.w[used]
            pull = miss[r][:, None] * (sums[r] - fm.v[c])
            grad_v = np.stack([np.bincount(at, pull[:, f], len(used)) for f in range(factors)], 1) + 1e-2 * fm.v[used]
            gw[used] += grad_w**2
            gv[used] += grad_v**2
            fm.w[used] -= 0.5 * grad_w / np.sqrt(gw[used])
            fm.v[used] -= 0.05 * grad_v / np.sqrt(gv[used])
            g0 += miss.sum() ** 2
            fm.w0 -= 0.2 * miss.sum() / np.sqrt(g0)
    return fm


def train_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 16_000, id_col: str = "doc_id", text_col: str = "text") -> FactorizationMachine:
    """Fit on at most ``sample_rows`` labelled rows outside the held-out quarter.

    The sample is the labelled ids with the smallest hash, so it is the same
    wherever rows lie; its ids are the only thing broadcast.  Its terms, bounded
    by ``sample_rows``, are stored and counted by Spark; the driver gets the
    few that the machine may keep, and fits it.  Null ids and null
    labels are left out; an id labelled twice counts as toxic if one label says so.
    """
    ids = labels.where(F.col(f"`{id_col}`").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col(f"`{id_col}`")))
    ids = ids.groupBy(F.col(f"`{id_col}`").alias("__id")).agg(F.max("toxic").alias("__toxic"))
    sample = ids.orderBy(F.xxhash64("__id"), "__id").limit(sample_rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    rows = texts.join(F.broadcast(sample), "__id").select("__id", "__toxic", "__text")

    def terms(batches):
        cache: dict = {}
        for b in batches:
            found = [x.tobytes() for x in _distinct_terms(b.column(2).to_pylist(), cache)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1).cast(pa.int32()), pa.array(found, pa.binary())], ["id", "toxic", "terms"])

    found = stored(rows.mapInArrow(lean(terms), "id bigint, toxic int, terms binary"), "toxicity-sample")
    keep = _telling_terms(found)

    def known(batches):
        for b in batches:
            lists = [np.frombuffer(t, "<i4") for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x[np.isin(x, keep)].tobytes() for x in lists], pa.binary())], ["id", "toxic", "terms"])

    got = sorted((r.id, r.terms, r.toxic) for r in found.mapInArrow(known, "id bigint, toxic int, terms binary").toLocalIterator())
    return fit_machine([np.frombuffer(t, "<i4") for _, t, _ in got], np.array([float(y) for _, _, y in got]))


def _telling_terms(found: DataFrame, screen: float = SCREEN, often: int = OFTEN) -> np.ndarray:
    """The terms of a sample that ``fit_machine`` can keep: those that pass its screen, and those in most documents.

    They are counted by Spark, so the sample's other terms, most of them, never reach the driver.
    """
    n_rows, n_toxic = found.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if n_toxic in (0, n_rows):
        return np.zeros(0, "<i4")

    def count(batches):
        for b in batches:
            docs = [np.frombuffer(t, "<i4") for t in b.column(2).to_pylist()]
            sizes = [len(d) for d in docs]
            terms, at = np.unique(np.concatenate(docs), return_inverse=True) if docs else (np.zeros(0, "<i4"), np.zeros(0, int))
            k = np.bincount(at, np.repeat(b.column(1).to_numpy().astype(float), sizes), len(terms))
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int32()), pa.array(np.bincount(at, minlength=len(terms)).astype(np.int64)), pa.array(k.astype(np.int64))], ["term", "n", "k"])

    counts = stored(found.mapInArrow(lean(count), "term int, n bigint, k bigint").groupBy("term").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "toxicity-counts")

    def part(x, share):
        return F.when(x > 0, x * F.log(x / (F.col("n") * share))).otherwise(0.0)

    share = n_toxic / n_rows
    ratio = 2 * (part(F.col("k"), share) + part(F.col("n") - F.col("k"), 1 - share))
    telling = counts.where(ratio >= screen - 1e-6).select("term").union(counts.orderBy(F.desc("n"), "term").limit(often).select("term"))
    return np.unique(np.array([r.term for r in telling.toLocalIterator()], "<i4"))


def toxicity_score(fm: FactorizationMachine, text: Column) -> Column:
    """Score in 0..1 of a whole text; null or empty texts get the machine's base score."""
    packed = (fm.terms, fm.w0, fm.w, fm.v)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = FactorizationMachine(*packed)
        lookup, cache = {int(t): i for i, t in enumerate(model.terms)}, {}
        for texts in batches:
            found = list(_distinct_terms(texts, cache, lookup))
            rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
            cols = np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)
            yield pd.Series(_sigmoid(model.raw(rows, cols, len(found))[0]))
        del lookup, cache
        release_memory()

    return score(text.cast("string"))
