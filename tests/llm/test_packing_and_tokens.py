"""Token ids, both packers and the piece codec against the tokenizer libraries themselves."""

import collections
import functools

import numpy as np
import pytest

from playgraph.llm.packed_ids import CapacityTree, best_fit_decreasing, matrix_segments, write_id_matrices
from playgraph.llm.packing_tiers import TierPacker, level_steps, pack_tiers
from playgraph.llm.piece_codec import PieceWalker, decode_pieces, encode_pieces
from playgraph.llm.tokens import ChunkEncoder, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")

ODD = [
    (1, "Plain words, it's a test. It's 3.5 o'clock; THE end!", "x"),
    (2, None, None),
    (3, "", "x"),
    (4, "  double  spaces\n\nand\ttabs \u00a0 nbsp ", "x"),
    (5, "Été éa ΣΟΦΟΣ İstanbul x² ½ 日本語 テスト、は \U0001f600\u200d foo_bar", "x"),
    (6, "long " * 9000, "x"),
    (7, "Plain words, it's a test. It's 3.5 o'clock; THE end!", "x"),
    (7, "Plain words, it's a test. It's 3.5 o'clock; THE end!", "x"),
    (None, "no id here", "x"),
    (8, "a<|endoftext|>b <|startoftext|>", "x"),
    (9, "...!!! 'tis ''s '' --e-- a..b \x1c a\x1fb \x85 z", "x"),
]
SCHEMA = "doc_id bigint, text string, ids string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@functools.cache
def _tokenizer():
    return tokenizers.Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def _ids(text):
    return _tokenizer().encode(text or "", add_special_tokens=False).ids + [1]


def test_chunk_encoder_equals_the_tokenizer(spark):
    enc = ChunkEncoder(tokenizer_path("word_bpe_49k.json"), cache_chunks=50)
    texts = [t for _, t, _ in ODD] + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for t, got in zip(texts, enc.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == _ids(t)[:-1], t


def _check_pieces(pieces, want, unit):
    """Pieces are (key, start, ids, tokens); every document comes back whole from its pieces."""
    by = collections.defaultdict(list)
    for key, start, ids, tokens in pieces:
        by[key].append((start, np.frombuffer(bytes(ids), unit).tolist(), tokens))
    got = collections.Counter()
    for key, parts in by.items():
        starts = sorted(s for s, _, _ in parts)
        whole = want[key]
        n = starts.count(0)
        got[key] += n
        joined = sorted(parts)
        at, used = 0, []
        for start, ids, tokens in joined[::n]:
            assert start == at and tokens == len(whole)
            used += ids
            at += len(ids)
        assert used == whole
    return got


def test_tiers_are_lossless_full_and_gapless(spark, odd):
    for docs in (odd, spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(3)):
        rows = docs.select("doc_id", "text").collect()
        want = {r.doc_id: _ids(r.text) for r in rows}
        out = pack_tiers(docs).collect()
        counts = _check_pieces([(r.doc_id, r.start, r.ids, r.doc_tokens) for r in out], want, "<u4")
        assert counts == collections.Counter(r.doc_id for r in rows)
        seqs = collections.defaultdict(list)
        for r in out:
            seqs[r.sequence_id].append(r)
        pad = total = 0
        for parts in seqs.values():
            parts.sort(key=lambda r: r.offset)
            at = 0
            for r in parts:
                assert r.offset == at and r.length == len(r.ids) // 4 and r.length > 0
                at += r.length
            assert at <= parts[0].tier and len({(r.tier, r.step_id) for r in parts}) == 1
            total += at
            pad += 0 if at & (at - 1) == 0 else 2048 - at
        assert pad <= 2048 * docs.rdd.getNumPartitions()
        steps = collections.Counter()
        for parts in seqs.values():
            steps[parts[0].step_id] += parts[0].tier
        assert max(steps.values()) <= 32_768


def test_tier_packer_by_random_sizes():
    rng = np.random.default_rng(1)
    for _ in range(60):
        windows = []
        p = TierPacker((4, 8, 16), lambda tier, pieces: windows.append((tier, pieces)))
        sizes = rng.integers(1, 40, rng.integers(0, 30)).tolist()
        for i, n in enumerate(sizes):
            p.add(i, n)
            if rng.random() < 0.3:
                p.flush(False)
        p.flush(True)
        cover = collections.Counter()
        for tier, pieces in windows:
            assert 0 < sum(x[2] for x in pieces) <= tier
            for doc, start, length in pieces:
                cover.update((doc, k) for k in range(start, start + length))
        assert cover == collections.Counter((i, k) for i, n in enumerate(sizes) for k in range(n))
        assert sum(sum(x[2] for x in pieces) < tier for tier, pieces in windows) <= 1


def test_step_groups_are_level():
    steps = level_steps(list(range(1, 33)), 8)
    load = collections.Counter()
    for cost, s in zip(range(1, 33), steps):
        load[s] += cost
    assert collections.Counter(steps) == {0: 8, 1: 8, 2: 8, 3: 8} and max(load.values()) - min(load.values()) <= 4


def test_best_fit_decreasing_against_a_plain_search():
    rng = np.random.default_rng(2)
    for _ in range(100):
        width = int(rng.integers(1, 30))
        sizes = rng.integers(1, width + 1, rng.integers(0, 40)).tolist()
        rows = best_fit_decreasing(sizes, width)
        free, plain = [], []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            fits = [f for f in free if f >= sizes[i]]
            plain.append(min(fits) if fits else width)
            if fits:
                free.remove(min(fits))
            free.append(plain[-1] - sizes[i])
        assert sorted(sum(rows, [])) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in r) <= width for r in rows)
        assert sorted(width - sum(sizes[i] for i in r) for r in rows) == sorted(free)
    tree = CapacityTree(5)
    assert tree.take(1) is None
    tree.put(3, 0)
    tree.put(5, 1)
    assert tree.take(4) == (5, 1) and tree.take(2) == (3, 0) and tree.take(1) is None


def test_matrices_hold_every_id_and_their_positions(spark, odd):
    matrices = write_id_matrices(odd, width=64, matrix_rows=3, block_tokens=5000)
    for m in matrices.collect():
        ids = np.frombuffer(bytes(m.ids), f"<u{m.id_bytes}").reshape(m.n_rows, m.width)
        pos = np.frombuffer(bytes(m.position_ids), "<u2").reshape(m.n_rows, m.width)
        assert len(m.cu_seqlens) == m.n_rows <= 3
        for r, cu in enumerate(m.cu_seqlens):
            assert cu[0] == 0 and cu[-1] <= m.width and not ids[r, cu[-1] :].any()
            for a, b in zip(cu, cu[1:]):
                assert pos[r, a:b].tolist() == list(range(b - a))
    got = matrix_segments(matrices).collect()
    want = {r.doc_id: _ids(r.text) for r in odd.collect()}
    counts = _check_pieces([(r.doc_id, r.start, r.ids, r.doc_tokens) for r in got], want, "<u2")
    assert counts == collections.Counter(r.doc_id for r in odd.collect())


def test_piece_codec_equals_the_library_and_round_trips(spark, odd):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = odd.select("doc_id", "text").union(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    want = collections.Counter((r.doc_id, tuple(sp.encode(r.text or "")), sp.decode(sp.encode(r.text or ""))) for r in docs.collect())
    rows = decode_pieces(encode_pieces(docs)).collect()
    assert collections.Counter((r.doc_id, tuple(np.frombuffer(bytes(r.ids), "<u4").tolist()), r.text) for r in rows) == want
    assert all(r.n_ids == len(r.ids) // 4 for r in rows)
    walker = PieceWalker(path)
    for t in ["a  b", " x ", "", "\u65e5\u672c \u2581x", "\U0001f600 e\u0301\u0301", "a\x00b", " ", "   ", "\n\n x"]:
        assert np.frombuffer(next(walker.encode([t])), "<u4").tolist() == sp.encode(t), t


def test_piece_walk_alone_is_right_on_every_word(spark):
    """Without the check against the library the forward pass already gives its ids."""
    path = tokenizer_path("piece_bpe_32k.model")
    walker = PieceWalker(path)
    words = set()
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        words.update(walker.marked_words(r.text))
    list(walker.encode([" ".join(w[1:] for w in sorted(words))]))
    assert walker.corrected == 0 and len(walker.cache) > 50_000


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert pack_tiers(none).count() == 0
    assert write_id_matrices(none).count() == 0
    assert decode_pieces(encode_pieces(none)).count() == 0
