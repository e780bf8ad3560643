"""Merkle manifest against a plain recursion over sorted rows."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import duckdb
import pytest

from encore.llm import merkle

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(s):
    return sha256(s.encode()).hexdigest()


def leaf_of(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def lower(t):
    return t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def reduce_with_proofs(digests):
    """root, and each place's [(left, right)] from the bottom."""
    paths, at, now = [[] for _ in digests], list(range(len(digests))), digests
    while len(now) > 1:
        for k, place in enumerate(at):
            run = place // 16 * 16
            paths[k].append(("".join(now[run:place]), "".join(now[place + 1:run + 16])))
        now = [h("".join(now[i:i + 16])) for i in range(0, len(now), 16)]
        at = [p // 16 for p in at]
    return now[0], paths


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        leaf = leaf_of(r)
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        groups[r[1]].append((r[0] is not None, r[0] or 0, leaf, leaf_of((*r[:4], lower(r[4]))) if tampered else leaf, r[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [sorted(groups[g]) for g in names]
    inner = [reduce_with_proofs([x[2] for x in t]) for t in trees]
    root, above = reduce_with_proofs([r for r, _ in inner])
    out = []
    for t, (subroot, paths), up in zip(trees, inner, above):
        for (_, _, leaf, changed, doc), path in zip(t, paths):
            node = changed
            for left, right in path + up:
                node = h(left + node + right)
            out.append((doc, leaf, subroot, root, h("".join(a + b for a, b in path + up)), node, node == root))
    return sorted(out, key=repr)


def got(spark, df, **kw):
    return sorted(map(tuple, merkle.manifest(df, **kw).collect()), key=repr)


def test_manifest_equals_plain_recursion(spark):
    rng = random.Random(3)
    rows = [(rng.choice([k, k + (1 << 40), -k, k << 33]), f"s{min(int(rng.expovariate(.5)), 6)}" if k % 9 else None,
             rng.choice(["en", None]), k, rng.choice(["Abc", "abc", "", None, "É X"])) for k in range(1, 700)]
    rows += [(None, "s0", None, None, "x"), (None, "s0", "en", 1, "y"), (None, None, None, None, None)]
    rows += [(7, "s0", "en", 7, "Twice")] * 40 + [(7, "s0", "en", 7, f"Other {k}") for k in range(30)]
    rows += [(5, "only", "en", 1, "A"), (1, "é", "en", 1, "B"), (1, "z", None, None, "C")]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], SCHEMA + ", leaf string, slot int").repartition(7)
    assert got(spark, df) == brute(rows)


def test_groups_of_more_than_one_array(spark, monkeypatch):
    rows = [(k * 3, "big", "en", k, f"Text {k}") for k in range(9000)] + [(1, "one", "en", 1, "A")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(spark, df) == brute(rows)


def test_a_third_of_the_rows_without_id(spark):
    rows = [(None, "a", None, None, "same")] * 600 + [(None, "a", None, None, f"t{k % 50}") for k in range(100)]
    rows += [(k, "a", None, None, "Z") for k in range(1000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(spark, df) == brute(rows)


def test_ranks_are_bounded_sums(spark):
    rng = random.Random(5)
    keys = sorted({rng.getrandbits(63) - (1 << 62) for _ in range(3000)} | set(range(-300, 300)) | {-(1 << 63), (1 << 63) - 1})
    df = spark.createDataFrame([(k, "g") for k in keys], "k bigint, g string").repartition(6)
    assert {r.k: r.slot for r in merkle.ranked(df, ["g"], ["k"]).collect()} == {k: i for i, k in enumerate(keys)}


def test_one_row_empty_table_and_long_text(spark):
    rows = [(3, None, None, None, "Long " * 200_000)]
    assert got(spark, spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    empty = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


def test_sql_on_test_table(spark):
    import __spark_entry__ as E
    df = E.queries()["op13_merkle_manifest"](spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    cur = con.execute(E.oracle_sql()["op13_merkle_manifest"])
    assert [c[0] for c in cur.description] == df.columns
    want = sorted(cur.fetchall(), key=repr)
    assert sorted(map(tuple, df.collect()), key=repr) == want
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    assert brute([tuple(r) for r in docs.collect()]) == want
