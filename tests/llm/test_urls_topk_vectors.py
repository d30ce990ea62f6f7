"""URL verdicts, exact top-k and embedding near-duplicates against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from playgraph.llm.components import connected_components
from playgraph.llm.queries import URL_RULES
from playgraph.llm.topk import exact_top_k
from playgraph.llm.url_filter import UrlTrie, judge_urls
from playgraph.llm.vector_dups import near_vectors

RULES = "host string, path string, verdict string"


def _fits(rule, host, path):
    return (host == rule[0] or host.endswith("." + rule[0])) and path.startswith(rule[1])


def _brute(rules, host, path):
    hits = [(len(r[0]) + len(r[1]), len(r[0]), r[2] == "block", r[0] + r[1], r[2]) for r in rules if _fits(r, host, path)]
    return max(hits)[3:] if hits else None


def test_trie_against_every_rule():
    rng = random.Random(3)
    for _ in range(300):
        hosts = [".".join(rng.choices(["a", "b", "com", ""], k=rng.randint(1, 3))) for _ in range(6)]
        paths = ["/".join(rng.choices(["", "x", "xy", "y"], k=rng.randint(1, 4))) for _ in range(6)]
        rules = [(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(8)]
        trie = UrlTrie(rules)
        for _ in range(20):
            h, p = rng.choice(["", "z."]) + rng.choice(hosts), rng.choice(["", "/"]) + rng.choice(paths) + rng.choice(["", "z", "/q"])
            assert trie.find(h, p) == _brute(rules, h, p), (rules, h, p)


URLS = [
    (1, "HTTPS://Www.Example.COM/en/a?x#y"), (2, "http://example.com/en/"), (3, "http://example.com/en"), (4, "x://shop.net/es/1"),
    (5, "x://net/fr/"), (6, None), (7, "no scheme"), (8, "a://b.com"), (9, "a://b.com?q=/en/"), (10, "a://example.com#/en/"),
    (11, "a://www.example.com.net/es/://x"), (12, "a://notexample.com/en/"), (13, "://com/"), (14, "a\nb://com/x\ny"), (14, "a\nb://com/x\ny"), (None, "a://com/"),
]


@pytest.mark.parametrize("max_trie", [100, 1])
def test_verdicts_both_ways(spark, max_trie):
    rules = spark.createDataFrame(URL_RULES + [("com", "/", "allow"), (None, "/", "block"), ("x", None, "block"), ("y", "/", "odd")], RULES)
    pages = spark.createDataFrame([(i, u, "old", 5) for i, u in URLS], "page_id bigint, url string, host string, rule int")
    out = judge_urls(pages, rules, max_trie_rules=max_trie)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = sorted((str(r.page_id), r.host, r.path, r.rule, r.verdict) for r in out.collect())
    want = []
    for i, u in URLS:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:cut].lower(), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
        rule = _brute([r for r in URL_RULES], host, path) or (None, "allow")
        want.append((str(i), host, path, *rule))
    assert got == sorted(want, key=lambda x: tuple(map(str, x))) or sorted(map(str, got)) == sorted(map(str, want))
    assert judge_urls(pages.limit(0), rules, max_trie_rules=max_trie).count() == 0
    assert {r.verdict for r in judge_urls(pages, rules.limit(0), default="block").collect()} == {"block"}


VEC = "vec_id bigint, embedding array<float>, score string"


def _vectors(rng, n, d, hot=0):
    base = rng.normal(size=(max(1, n // 6), d))
    rows = [(i, (base[i % len(base)] + rng.normal(size=d) * rng.choice([0.02, 0.2, 1.0])).astype(np.float32).tolist()) for i in range(n)]
    return rows + [(n + i, rows[0][1]) for i in range(hot)]


ODD_VECTORS = [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [math.nan] + [1.0] * 7), (1004, [math.inf] + [1.0] * 7), (1005, [None] + [1.0] * 7), (1006, [1.0] * 3), (None, [1.0] * 8)]


def _top(rows, k, every):
    ok = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % every == 0:
            best = sorted((-int((a[: min(len(a), len(b))] * b[: min(len(a), len(b))]).sum()), i) for i, b in ok if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("bins", [2, 128])
def test_top_k_with_ties_and_odd_rows(spark, bins):
    rows = _vectors(np.random.default_rng(4), 150, 8, hot=60) + ODD_VECTORS
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VEC)
    got = sorted(tuple(r) for r in exact_top_k(df.union(df.limit(20)), F.col("vec_id") % 10 == 0, k=5, bins=bins).collect())
    assert got == _top(rows, 5, 10)


def test_top_k_small_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], "x"), (1, [3.0, 4.0], "x"), (10, [-1e-9, 0.0], "x")], VEC)
    got = sorted(tuple(r) for r in exact_top_k(df, F.col("vec_id") % 10 == 0, k=5).collect())
    assert got == _top([(0, [1.0, 2.0]), (1, [3.0, 4.0]), (10, [-1e-9, 0.0])], 5, 10)
    assert exact_top_k(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert exact_top_k(df.limit(1), F.col("vec_id") % 10 == 0).count() == 0


def _near(rows, t):
    out = {}
    ok = []
    for n, (i, v) in enumerate(rows):
        good = i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        ok.append(np.array(v, float) if good else None)
    up = {}

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            x, y = ok[a], ok[b]
            if x is not None and y is not None and len(x) == len(y) and float(x @ y) / math.sqrt(float(x @ x) * float(y @ y)) >= t:
                links[a] += 1
                links[b] += 1
                p, q = root(rows[a][0]), root(rows[b][0])
                up[max(p, q)] = min(p, q)
    return sorted((str(i), links[n], None if i is None else root(i)) for n, (i, _) in enumerate(rows))


def test_near_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = _vectors(rng, 260, 8, hot=40) + ODD_VECTORS + [(2000, (np.array(_vectors(rng, 1, 8)[0][1]) * 3).tolist())]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VEC)
    got = near_vectors(df, 0.9)
    assert sorted((str(r.vec_id), r.n_links, r.component_id) for r in got.collect()) == _near([(i, np.float32(v).tolist() if v and None not in v else v) for i, v in rows], 0.9)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect() if r.vec_id is not None)
    assert near_vectors(df.limit(0)).count() == 0


def test_near_vectors_on_the_test_table(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = entry.queries()["op5_vector_dups"](spark, "/root/testdata/sf0.001").collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id) for r in got) == _near(rows, 0.9)


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(500, x) for x in range(501, 560)] + [(7, 7)]
    up = {}

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
