"""Near-duplicate documents by a MinHash signature-coordinate inverted join.

1. Each whole text becomes its set of hashed word shingles, a fingerprint of the
   set, and ``COORDS`` MinHash coordinates.  Documents of equal sets form a
   class; only class representatives go on.
2. Every representative is posted under its coordinate-value pairs.  Two sets of
   the wanted similarity agree in at least ``needed`` coordinates (five standard
   deviations below the mean), so of each one's ``COORDS - needed + COMMON``
   globally rarest pairs they share at least COMMON: only those prefixes stay
   posted, and pairs seen once drop out.
3. Posting lists are merged without writing a group's pairs out.  First every
   member meets its list's leader; collisions are counted, pairs with enough of
   them are compared by signature, and each member's best leader is confirmed on
   the full sets.  That joins most copies in linear work.  Then lists that still
   hold several components are merged: in short lists collisions are counted
   pair by pair (COMMON are needed); in long ones members outside the largest
   component (probes) meet the others in bounded blocks and need ``needed`` equal
   coordinates.  Sizes that cannot match and pairs already joined are skipped.
4. Candidates travel as one row per probe and block of documents and are
   confirmed on full sets, skipping what earlier links in the block joined.
   Links become components.

A pair of different components that shares no long list shares COMMON short
ones, so both ways together miss nothing that step 2 keeps.  Lists and blocks
are split by size, so a hot pair or group is spread over tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import UPPER, lean, small_batches, stored
from .vector_dups import Forest

COORDS, COMMON = 64, 4
SHORT_LIST, LIST_BLOCK, DOC_BLOCK, PROBES = 16, 1024, 256, 512
BROADCAST_ROWS, BROADCAST_BYTES, SETS_BYTES = 300_000, 48 << 20, 4 << 20
LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
_RNG = np.random.default_rng(20)
MULT = _RNG.integers(1, 2**62, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLUS = _RNG.integers(0, 2**63, COORDS, dtype=np.uint64)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles (A-Z lower-cased, words between ASCII white space)."""

    def __init__(self, size: int, cache_words: int = 100_000):
        self.size, self.cache, self.cache_words = size, {}, cache_words

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
        if not words:
            return np.zeros(0, np.uint64)
        cache = self.cache
        if len(cache) > self.cache_words:
            cache.clear()
        for w in set(words):
            if w not in cache:
                cache[w] = xxhash.xxh3_64_digest(w)
        h = np.frombuffer(b"".join(map(cache.__getitem__, words)), ">u8").astype(np.uint64)
        n = min(self.size, len(words))
        x = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            x = x * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i]
            x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return np.unique(x ^ (x >> np.uint64(29)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash coordinates of a non-empty set."""
    out = np.full(COORDS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingles), 8192):
        np.minimum(out, (shingles[a : a + 8192, None] * MULT + PLUS).min(0), out=out)
    return (out >> np.uint64(32)).astype("<u4")


def needed_matches(percent: int) -> int:
    s = percent / 100
    return max(1, int(COORDS * s - 5 * np.sqrt(COORDS * s * (1 - s))))


def _features(size):
    def run(batches):
        shingle = Shingler(size)
        for b in small_batches(batches):
            n, fp, sig = [], [], []
            for text in b.column(1).to_pylist():
                s = shingle(text)
                n.append(len(s))
                fp.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(sig, pa.binary())], ["doc_id", "text_hash", "n_shingles", "fp", "sig"])

    return run


def _post(batches):
    for b in batches:
        sig = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u4").reshape(-1, COORDS).astype(np.int64)
        cv = (np.arange(COORDS, dtype=np.int64) << 32) | sig
        yield pa.RecordBatch.from_arrays([pa.array(cv.ravel()), pa.array(np.repeat(b.column(0).to_numpy(), COORDS))], ["cv", "rep"])


def _sizes_fit(a, b, percent):
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _leader_matches(needed, percent):
    """(rep, n, sig, leader, leader_n, leader_sig) to (rep, leader, matches) where enough coordinates agree."""

    def run(batches):
        for b in batches:
            c = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            x, y = (np.frombuffer(b"".join(c[k].to_pylist()), "<u4").reshape(-1, COORDS) for k in ("sig", "leader_sig"))
            got = (x == y).sum(1)
            ok = (got >= needed) & _sizes_fit(c["n"].to_numpy(), c["leader_n"].to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([c["rep"].filter(pa.array(ok)), c["leader"].filter(pa.array(ok)), pa.array(got[ok].astype(np.int64))], ["rep", "leader", "matches"])

    return run


def _bits(masks: list[int]) -> np.ndarray:
    """One row of COORDS booleans per 64-bit mask."""
    return np.unpackbits(np.array(masks, "<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)


def _probe_lists(needed, percent):
    """Rows sorted by (cv, blk, probe flag): members of a list block, then probes; yields (probe, block, members).

    ``posted`` has a bit for each coordinate under which a document is in a long
    list.  Two documents may share many lists; their pair is handed on by the
    list of the first coordinate they share only.
    """

    def run(batches):
        key, members, packed = None, [], None

        for b in batches:
            rows = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
            out = {}
            for i in range(b.num_rows):
                if (rows["cv"][i], rows["blk"][i]) != key:
                    key, members, packed = (rows["cv"][i], rows["blk"][i]), [], None
                mine = (rows["rep"][i], rows["comp"][i], rows["n"][i], rows["is_probe"][i], rows["home"][i], rows["sig"][i], rows["posted"][i])
                if rows["kind"][i] == 0:
                    members.append(mine)
                    continue
                if packed is None:
                    packed = [np.array([m[k] for m in members]) for k in range(5)] + [np.frombuffer(b"".join(m[5] for m in members), "<u4").reshape(-1, COORDS), _bits([m[6] for m in members])]
                if not members:
                    continue
                ids, comps, ns, probes, homes, sigs, posted = packed
                ok = (comps != mine[1]) & _sizes_fit(ns, mine[2], percent) & (~probes | (ids > mine[0]))
                at = np.flatnonzero(ok)
                same = sigs[at] == np.frombuffer(mine[5], "<u4")
                enough = same.sum(1) >= needed
                at, same = at[enough], same[enough]
                at = at[(same & posted[at] & _bits([mine[6]])).argmax(1) == key[0] >> 32]
                for j in at.tolist():
                    out.setdefault((mine[0], int(homes[j])), set()).add(int(ids[j]))
            keys = list(out)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([sorted(out[k]) for k in keys], pa.list_(pa.int64()))], ["probe", "block", "members"])

    return run


def _confirm(percent):
    """Rows sorted by (block, salt, kind): the block's sets, then probes with their member lists; yields confirmed links."""

    def run(batches):
        key, sets, forest = None, {}, Forest()
        for b in small_batches(batches):
            rows = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
            edges = []
            for i in range(b.num_rows):
                if (rows["block"][i], rows["salt"][i]) != key:
                    key, sets, forest = (rows["block"][i], rows["salt"][i]), {}, Forest()
                doc, comp, mine = rows["doc"][i], rows["comp"][i], np.frombuffer(rows["shingles"][i], np.uint64)
                if rows["kind"][i] == 0:
                    sets[doc] = (comp, mine)
                    continue
                for m in rows["members"][i]:
                    if m not in sets or m == doc:
                        continue
                    other_comp, other = sets[m]
                    if forest.root(comp) == forest.root(other_comp) or not _sizes_fit(len(mine), len(other), percent):
                        continue
                    at = np.searchsorted(mine, other)
                    at[at == len(mine)] = 0
                    both = int((mine[at] == other).sum())
                    if 100 * both >= percent * (len(mine) + len(other) - both):
                        forest.join(comp, other_comp)
                        edges.append((doc, m))
            yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], ["a", "b"])

    return run


def _confirmed(texts: DataFrame, lists: DataFrame, homes: DataFrame, size: int, percent: int) -> DataFrame:
    """Links among ``lists(probe, block, members)``.

    ``homes(rep, doc, fp_wanted, comp, home)`` says in which block a class is
    held and whose text stands for it.  What a class is asked for is gathered
    first, so its text is joined and shingled once (per 64 uses of a class asked
    for very often).  The work table holds ids, no texts; while its bytes are few
    it is broadcast to the text scan, a larger one is joined by a shuffle.
    """
    salts = lists.groupBy("block").agg(F.ceil(F.count("*") / PROBES).cast("int").alias("salts"))
    held = homes.join(salts, F.col("home") == F.col("block")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    cols = ["rep", "doc", "fp_wanted", "comp", "block", "salt", "kind", "members", "part"]
    held = held.withColumn("kind", F.lit(0)).withColumn("members", F.array().cast("array<bigint>")).withColumn("part", F.col("salt").cast("bigint") - F.pmod("salt", F.lit(64))).select(cols)
    asking = lists.join(salts, "block").join(homes, F.col("probe") == F.col("rep"))
    asking = asking.withColumn("salt", F.pmod(F.xxhash64("probe"), "salts").cast("int")).withColumn("kind", F.lit(1)).withColumn("part", -1 - F.pmod(F.xxhash64("block"), F.lit(16))).select(cols)
    uses = F.collect_list(F.struct("block", "salt", "kind", "members")).alias("uses")  # at most 64 blocks held, or a sixteenth of those asked
    work = stored(held.union(asking).groupBy("rep", "doc", "fp_wanted", "comp", "part").agg(uses).drop("part"), "near-work")
    rows, size_of = work.agg(F.count("*"), F.sum(64 + F.aggregate("uses", F.lit(0), lambda n, u: n + 32 + 8 * F.size(u["members"])))).first()
    side = F.broadcast(work) if rows <= BROADCAST_ROWS and (size_of or 0) <= BROADCAST_BYTES else work
    joined = texts.join(side, F.col("doc_id") == F.col("doc")).select("rep", "fp_wanted", "comp", "text", "uses")
    names = ["block", "salt", "kind", "doc", "comp", "members", "shingles"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]

    def sets(batches):
        shingle, seen, last = Shingler(size), set(), (None, None, None)
        out, held_bytes = [], 0
        for b in small_batches(batches, 50):
            for row in b.to_pylist():
                if last[0] != row["text"]:
                    found = shingle(row["text"])
                    last = (row["text"], found.tobytes(), hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                if last[2] != row["fp_wanted"]:  # another text of this id
                    continue
                for u in row["uses"]:
                    key = (row["rep"], u["block"], u["salt"], u["kind"])
                    if key in seen:  # the same text again
                        continue
                    seen.add(key)
                    out.append((u["block"], u["salt"], u["kind"], row["rep"], row["comp"], u["members"], last[1]))
                    held_bytes += len(last[1])
                    if held_bytes > SETS_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                        out, held_bytes = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    rows = joined.mapInArrow(lean(sets), "block bigint, salt int, kind int, doc bigint, comp bigint, members array<bigint>, shingles binary")
    # Two tasks may hold the same text of one id: a set counts once per place.
    rows = rows.repartition("block", "salt").sortWithinPartitions("block", "salt", "kind", "doc")
    return rows.mapInArrow(lean(_confirm(percent)), "a bigint, b bigint")


def _shared_ids(feats: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of ids that occur with unequal texts: rows of one id are one document."""
    known = feats.where("fp is not null and doc_id is not null").select("doc_id", "fp")
    print_ = F.xxhash64("fp")
    mixed = known.groupBy("doc_id").agg(F.min(print_).alias("lo"), F.max(print_).alias("hi")).where("lo <> hi").select("doc_id")
    nodes = known.join(mixed, "doc_id").distinct().join(classes.select("fp", "rep"), "fp").select("doc_id", "rep")
    return nodes.join(nodes.groupBy("doc_id").agg(F.min("rep").alias("b")), "doc_id").where("rep <> b").select(F.col("rep").alias("a"), "b")


def near_documents(
    docs: DataFrame, shingle_words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", by_text: bool = False
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per input row.

    Links join documents whose shingle sets satisfy 100 * |A & B| >= percent *
    |A | B|; the component is the smallest id reachable.  Texts with fewer words
    than a shingle are one shingle; null, empty and blank texts link with
    nothing.  Rows with a null id stay as such and link with nothing; rows
    sharing an id are one document and share a component, whatever their texts.
    With ``by_text`` they are documents of their own: a row belongs to the
    component of its text, and a column ``text_hash`` (xxhash64 of the text)
    tells which.  Other columns are ignored; an empty table gives no rows.
    """
    text = F.col(f"`{text_col}`").cast("string")
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    needed = needed_matches(percent)
    prefix = min(COORDS, COORDS - needed + COMMON)
    feats = stored(texts.mapInArrow(lean(_features(shingle_words)), "doc_id bigint, text_hash bigint, n_shingles bigint, fp binary, sig binary"), "near-features")
    # A class (texts of equal sets) is a node, numbered when it is stored; the text of its smallest id stands for it.
    reps = feats.where("fp is not null and doc_id is not null").groupBy("fp", "n_shingles", "sig").agg(F.min("doc_id").alias("doc"))
    reps = stored(reps.select("fp", "doc", F.col("n_shingles").alias("n"), "sig", F.monotonically_increasing_id().alias("rep")), "near-classes")
    sigs = reps.select("rep", "n", "sig")

    postings = reps.select("rep", "sig").mapInArrow(lean(lambda it: _post(b.select(["rep", "sig"]) for b in it)), "cv bigint, rep bigint")
    shared = postings.groupBy("cv").agg(F.count("*").alias("df")).where("df > 1")
    by_doc = postings.join(shared, "cv").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("df", "cv"))).alias("cvs"))  # at most COORDS entries
    free = prefix - (COORDS - F.size("cvs"))
    post = by_doc.where(free >= COMMON).select("rep", F.explode(F.slice("cvs", F.lit(1), F.greatest(free, F.lit(1)))).alias("x")).select("rep", F.col("x.cv").alias("cv"))
    post = stored(post, "near-postings")

    # Leaders: every member of a list against its smallest id, best match confirmed.
    lead = post.groupBy("cv").agg(F.min("rep").alias("leader"), F.count("*").alias("c")).where("c > 1").select("cv", "leader")
    cand = post.join(lead, "cv").where("rep <> leader").groupBy("rep", "leader").agg(F.count("*").alias("hits")).where(F.col("hits") >= COMMON).drop("hits")
    cand = cand.join(sigs, "rep").join(sigs.select(F.col("rep").alias("leader"), F.col("n").alias("leader_n"), F.col("sig").alias("leader_sig")), "leader")
    matched = cand.select("rep", "n", "sig", "leader", "leader_n", "leader_sig").mapInArrow(lean(_leader_matches(needed, percent)), "rep bigint, leader bigint, matches bigint")
    best = matched.groupBy("rep").agg(F.max("matches").alias("m"), F.max_by("leader", F.struct("matches", -F.col("leader"))).alias("leader"))
    best = stored(best.select("rep", "leader"), "near-leaders")
    known = reps.select("rep", "doc", "n", F.col("fp").alias("fp_wanted"))
    alone = best.select("rep").union(best.select(F.col("leader").alias("rep"))).distinct().join(known, "rep")
    alone = alone.select("rep", "doc", "fp_wanted", F.col("rep").alias("comp"), F.col("rep").alias("home"))
    first = best.select(F.col("rep").alias("probe"), F.col("leader").alias("block"), F.array("leader").alias("members"))
    links = stored(_confirmed(texts, first, alone, shingle_words, percent), "near-links")
    comps = connected_components(links, "near-first")

    # The rest: lists that hold several components.
    where = post.select("rep").distinct().join(comps.withColumnRenamed("node", "rep"), "rep", "left").join(best, "rep", "left")
    lead_comp = comps.select(F.col("node").alias("leader"), F.col("component").alias("lead_comp"))
    where = where.join(lead_comp, "leader", "left").select("rep", F.coalesce("component", "rep").alias("comp"), F.coalesce("component", "lead_comp", "leader", "rep").alias("family"))
    crowd = where.groupBy("family").agg(F.ceil(F.count("*") / DOC_BLOCK).alias("parts"))
    homes = where.join(crowd, "family").join(known, "rep").select("rep", "doc", "n", "fp_wanted", "comp", F.xxhash64("family", F.pmod(F.xxhash64("rep"), "parts")).alias("home"))
    homes = stored(homes, "near-homes")
    placed = post.join(homes.select("rep", "n", "comp", "home"), "rep")
    counts = placed.groupBy("cv", "comp").agg(F.count("*").alias("k"))
    mixed = counts.groupBy("cv").agg(F.count("*").alias("n_comps"), F.sum("k").alias("size"), F.max_by("comp", F.struct("k", "comp")).alias("main"))
    mixed = mixed.where("n_comps > 1").drop("n_comps")

    short = placed.join(mixed.where(F.col("size") <= SHORT_LIST).select("cv"), "cv")
    other = short.select("cv", *[F.col(c).alias(f"{c}2") for c in ("rep", "n", "comp", "home")])
    fits = f"rep < rep2 and comp <> comp2 and 100 * least(n, n2) >= {percent} * greatest(n, n2)"
    pairs = short.join(other, "cv").where(fits).groupBy("rep", "rep2", "home2").agg(F.count("*").alias("hits")).where(F.col("hits") >= COMMON)
    pairs = pairs.select(F.col("rep").alias("probe"), F.col("home2").alias("block"), F.array("rep2").alias("members"))

    listed = placed.join(mixed.where(F.col("size") > SHORT_LIST), "cv").join(sigs.select("rep", "sig"), "rep")
    listed = listed.withColumn("is_probe", F.col("comp") != F.col("main")).withColumn("blocks", F.ceil(F.col("size") / LIST_BLOCK).cast("int"))
    posted = listed.groupBy("rep").agg(F.expr("bit_or(shiftleft(1L, cast(shiftright(cv, 32) as int)))").alias("posted"))
    listed = listed.join(posted, "rep")
    cols = ["cv", "blk", "kind", "rep", "comp", "n", "is_probe", "home", "sig", "posted"]
    members = listed.withColumn("blk", F.pmod(F.xxhash64("rep"), "blocks").cast("int")).withColumn("kind", F.lit(0)).select(cols)
    probes = listed.where("is_probe").withColumn("blk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("kind", F.lit(1)).select(cols)
    ordered = members.union(probes).repartition("cv", "blk").sortWithinPartitions("cv", "blk", "kind", "rep")
    lists = pairs.union(ordered.mapInArrow(lean(_probe_lists(needed, percent)), "probe bigint, block bigint, members array<bigint>"))
    lists = stored(lists.groupBy("probe", "block").agg(F.array_distinct(F.flatten(F.collect_list("members"))).alias("members")), "near-lists")  # members of one block
    more = _confirmed(texts, lists, homes.drop("n"), shingle_words, percent)
    links = links.union(more) if by_text else links.union(more).union(_shared_ids(feats, reps))
    comps = connected_components(stored(links, "near-all-links"), "near-last")

    nodes = reps.select("fp", "rep", "doc").join(comps.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    label = nodes.join(nodes.groupBy("component").agg(F.min("doc").alias("component_id")), "component").select("fp", "component_id")
    out = feats.select("doc_id", "text_hash", "n_shingles", F.expr("case when doc_id is not null then fp end").alias("fp")).join(label, "fp", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), *(["text_hash"] if by_text else []))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
