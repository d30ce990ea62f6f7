"""Quality rules and cross-document line frequency against plain Python."""

import collections
import random
import re

import pytest

from playgraph.llm import quality_lines as ql

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _rows(seed=3, n=120):
    rng = random.Random(seed)
    words = ["Wort%d" % i for i in range(40)] + ["naïve", "ab#c", "$5", "日本", "x" * 300]
    footer = "Site map  Contact\tAll rights 2024"
    rows = []
    for i in range(n):
        lines = [" ".join(rng.choices(words, k=rng.randint(0, 25))) for _ in range(rng.randint(1, 6))]
        lines += rng.choices(lines, k=rng.choice([0, 0, 2]))
        if rng.random() < 0.4:
            lines.append(footer.replace("2024", str(rng.randint(2000, 2030))).upper() if rng.random() < 0.5 else footer)
        rows.append((i, rng.choice(["\n", "\n\n", "\n\r\n"]).join(lines), rng.choice(["a", "a", "a", "b", None])))
    for k in range(9):  # documents that are little but shared lines
        rows.append((500 + k, "\n".join([" ".join(f"notice{j}x" + "ab"[j % 2] * j for j in range(60)), "and one more that is the same too", f"end {k}" + "z" * k]), "b"))
    rows += [(i + 900, rows[0][1], rows[0][2]) for i in range(30)]  # copies of one text
    return rows + [(None, None, "a"), (950, "", "a"), (951, " \t\n\x0b\n", "b"), (952, "a b c a b c", "a"), (953, "a a a a", None), rows[4], rows[4], (954, "long " * 20000, "a")]


def _brute(rows, min_docs=5, share=0.05, max_lost=50):
    up, down = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0000000000"
    norm = lambda s: re.sub(r"[\x20\x09-\x0D]+", "", s.translate(str.maketrans(up, down)))
    texts, where = collections.defaultdict(set), collections.defaultdict(set)
    for _, t, host in rows:
        texts[host].add(t or "")
        for s in (t or "").split("\n"):
            if norm(s):
                where[host, norm(s)].add(t)
    hot = {k for k, v in where.items() if len(v) > min_docs and len(v) > share * len(texts[k[0]])}
    out = []
    for i, t, host in rows:
        t = t or ""
        w, lines = WORD.findall(t), t.split("\n")
        seen = collections.Counter(zip(w, w[1:], w[2:]))
        cover = {j + d for j, x in enumerate(zip(w, w[1:], w[2:])) if seen[x] > 1 for d in range(3)}
        full = [s for s in lines if WORD.search(s)]
        lost = [s for s in full if (host, norm(s)) in hot]
        chars, gone = sum(map(len, w)), sum(len(norm(s)) for s in lost)
        bad, out_of = len(w) < 50 or 100 * len(cover) > 50 * len(w), 100 * gone > max_lost * chars
        clean = "\n".join(s for s in lines if (host, norm(s)) not in hot) if lost else t
        out.append((i, len(w), chars, sum(c in "#*$%&|<>" for c in t), len(full) - len(set(full)), len(cover), bad, not bad and not out_of, len(lost), gone, out_of, clean))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast_lines", [1000, 0])
def test_against_brute_force(spark, broadcast_lines):
    rows = _rows()
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], SCHEMA).repartition(5)
    got = ql.quality_rules(docs, clean_as="clean", broadcast_lines=broadcast_lines)
    got = sorted([(*r[:-1], r.clean or "") for r in got.collect()], key=str)
    want = _brute(rows)
    assert got == want
    assert any(r[10] and not r[6] for r in want) and any(r[8] for r in want)


def test_limits_and_columns(spark):
    """Stricter limits lose more lines; ids and hosts of other names, clashing extra columns, other kept columns."""
    rows = _rows(5)
    docs = spark.createDataFrame([(i, t, s, 7, 8) for i, t, s in rows], "h bigint, body string, site string, chars int, n_words int")
    got = ql.quality_rules(docs, "body", "site", keep=["h", "site"], min_docs=1, share=0.0, max_lost=10).select("h", "lost_lines", "lost_chars", "depleted", "kept")
    want = sorted([(r[0], r[8], r[9], r[10], r[7]) for r in _brute(rows, 1, 0.0, 10)], key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_empty_table(spark):
    out = ql.quality_rules(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and out.columns[:3] == ["doc_id", "n_words", "word_chars"]


def test_native_plan(spark):
    """Built-in expressions only: no Python node in the plan."""
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5)], SCHEMA)
    plan = ql.measured(docs, "text", "source", ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
