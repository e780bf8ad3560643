"""Spelling variants against edit distances of all pairs, and against SQL."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from encore.llm import spelling

SF_SMALL = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def counts(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def brute(rows):
    n = counts(rows)
    near = {w: [] for w in n}
    for a in n:
        for b in n:
            if a < b and abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].append(b), near[b].append(a)
    form = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: f for w, f in form.items() if n[f] >= 2 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w
    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n)


def got(df):
    return sorted(tuple(r) for r in spelling.spelling_variants(df).select(
        "word", "form", "root", "n", "n_near", "form_n").collect())


def corpus(seed, words, edits):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcàÿ", k=rng.randrange(5, 10))) for _ in range(words)]
    out = []
    for w in base:
        out += [w] * rng.randrange(3, 60)
        for _ in range(edits):
            k = rng.randrange(len(w))
            v = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abcÿ") + w[k:], w[:k] + rng.choice("abÀ") + w[k + 1:]])
            out += [v] * rng.randrange(1, 8)
    rng.shuffle(out)
    return [(k, rng.choice([" ", ", ", "1", "\n"]).join(out[k::50])) for k in range(50)]


def test_variants_equal_all_pairs(spark):
    rows = corpus(1, 120, 8) + [(None, "Hello Hello hellO helo Hellos " * 5), (None, None), (7, ""), (8, "ÉÉÉÉÉ ééééé " * 9),
                                (9, "straße " * 3), (10, "x" * 3000 + " " + "x" * 2999 + " "), (11, ("x" * 3000 + " ") * 7)]
    rows += [(12, "repeat repeats " * 2)] * 3
    df = spark.createDataFrame([(*r, "w", 3) for r in rows], "doc_id bigint, text string, word string, n int").repartition(6)
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 100 and any(r[2] not in (r[0], r[1]) for r in want)
    assert got(df) == want


@pytest.mark.parametrize("limits", [(8, 1 << 20, 3), (1024, 40, 2), (16, 1 << 20, 32)])
def test_any_tile_size_gives_the_same(spark, monkeypatch, limits):
    rows = corpus(2, 60, 10)
    for name, value in zip(("ROWS", "CELLS", "SMALL"), limits):
        monkeypatch.setattr(spelling, name, value)
    assert got(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)) == brute(rows)


def test_near_is_one_edit():
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("ab", k=rng.randrange(1, 7))) for _ in range(200)} | {"aab", "aaab", "éa", "é"})
    hit, _ = spelling.near(words, words)
    assert (hit == np.array([[one_edit(a, b) for b in words] for a in words])).all()


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_sql_on_test_table(spark):
    import __spark_entry__ as E
    df = E.queries()["op12_spelling_variants"](spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    cur = con.execute(E.oracle_sql()["op12_spelling_variants"])
    assert [c[0] for c in cur.description] == df.columns
    want = sorted(cur.fetchall())
    assert sorted(map(tuple, df.collect())) == want
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    assert brute([tuple(r) for r in docs.collect()]) == want
