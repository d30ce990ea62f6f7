"""Tiles that travel in sides: small tiles and sides give the links of brute force."""

import numpy as np
import pytest

from playgraph.llm import vector_dups
from playgraph.llm.vector_dups import near_vectors


@pytest.mark.parametrize("tile,side", [(16, 2), (16, 8), (1024, 8)])
def test_links_across_sides(spark, monkeypatch, tile, side):
    monkeypatch.setattr(vector_dups, "TILE", tile)
    monkeypatch.setattr(vector_dups, "SIDE", side)
    rng = np.random.default_rng(12)
    base = rng.normal(size=(25, 12))
    rows = [(i, (base[i % 25] + rng.normal(size=12) * rng.choice([0.0, 0.1, 0.4, 1.0])).tolist()) for i in range(260)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    m = np.array([v for _, v in rows])
    u = m / np.linalg.norm(m, axis=1)[:, None]
    link = u @ u.T >= 0.9
    comp = np.arange(len(rows))
    while True:
        new = np.array([comp[link[i]].min() for i in range(len(rows))])
        if (new == comp).all():
            break
        comp = new
    assert got == {i: (int(link[i].sum()) - 1, int(comp[i])) for i in range(len(rows))}
