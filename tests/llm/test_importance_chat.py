"""Quality rules against a plain computation; chat collapse against SQL over whole prefixes."""

import collections
import math
import random
import re

import duckdb
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from encore.llm import chat, importance

SF_SMALL = "/root/testdata/sf0.001"

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def rules(t):
    t = t or ""
    ws = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    covered = {j for i in range(len(ws) - 7) if windows[tuple(ws[i:i + 8])] > 1 for j in range(i, i + 8)}
    n = len(ws)
    return (n, sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), dup, len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def texts():
    rng = random.Random(4)
    out = [None, "", " \n\t\x0b", "a", "é𝒳 ß x\x1cy", "## <a> | %$&*\n\n \nx\nx\nx", "w " * 30, "a b c d e f g h " * 2]
    for _ in range(40):
        ws = rng.choices(["the", "of", "Xy", "é.", "a,", "%%", "q1", "\n", "\n\n", "  "], k=rng.randrange(200))
        out.append(" ".join(ws) + " " + " ".join(ws[:rng.randrange(30)]))
    return out + [" ".join(rng.choices(["alpha", "beta", "gamma", "delta", "eps"], k=60)) for _ in range(20)]


def test_quality_equals_plain_computation(spark):
    ts = texts()
    rows = [(i if i else None, t, 1.0, False) for i, t in enumerate(ts)] + [(5, ts[5], 2.0, True)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, llr double, ws boolean").repartition(3)
    trusted = spark.createDataFrame([(k,) for k in range(8, len(ts), 2)] + [(8,), (None,)], "doc_id bigint")
    got = importance.quality(df, trusted, buckets=100)

    h = lambda vals: signed(xxhash.xxh64(vals, seed=42).intdigest())

    def chain(a, b):  # Spark folds columns: the first hash seeds the next
        first = xxhash.xxh64(a.to_bytes(8, "little", signed=True), seed=42).intdigest()
        return signed(first if b is None else xxhash.xxh64(b.to_bytes(8, "little", signed=True), seed=first).intdigest())
    feats = []
    for _, t, *_ in rows:
        hs = [h(x.encode()) for x in regex.findall(r"[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\x0b\f\r]+", t or "")]
        feats.append([x % 100 for x in hs] + [chain(a, b) % 100 for a, b in zip(hs, [*hs[1:], None])])
    raw, tgt = [1] * 100, [1] * 100
    ids = set(range(8, len(ts), 2))
    for (d, *_), f in zip(rows, feats):
        for b in f:
            raw[b] += 1
            tgt[b] += d in ids
    ratio = [math.log(a / sum(tgt)) - math.log(b / sum(raw)) for a, b in zip(tgt, raw)]
    want = []
    for (d, t, *_), f in zip(rows, feats):
        llr = sum(ratio[b] for b in f) / len(f) if f else 0.0
        r = rules(t)
        want.append((d, *r, round(llr, 9), not r[-1] and llr >= -0.05))
    order = lambda r: (r[0] is None, r[0] or 0)
    out = got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                     "llr", "kept").collect()
    assert sorted([(*r[:7], round(r[7], 9), r[8]) for r in out], key=order) == sorted(want, key=order)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quality_separates_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = importance.quality(docs, labels.where("quality = 1 AND toxic = 0").select("doc_id"))
    rate = {(r.quality, r.base_failed): r.k for r in got.join(labels, "doc_id").groupBy("quality", "base_failed").agg(
        F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert rate[(1, False)] > 0.99 and rate[(0, False)] < 0.05


def test_quality_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert importance.quality(docs, docs.select("doc_id")).count() == 0


def run_sql(rows, key=None):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(con.execute(chat.SQL).fetchall(), key=key)


def test_chat_equals_sql(spark):
    rng = random.Random(6)
    rows = []
    for c in range(120):
        base = random.Random(rng.randrange(12))
        n = rng.randrange(1, 9)
        for t in range(n):
            rows.append((c, t, base.choice(["user", "assistant", None]), base.choice(["hi", "", None, "x\ny"])))
    rows += [(500, None, "user", "a"), (500, 0, "user", "b"), (501, 0, "user", "b"), (501, 0, "user", "b"), (502, 0, "user", "b"),
             *[(600, t, "user", f"m{t}") for t in range(4090, 4105)], *[(601, t, "user", f"m{t}") for t in range(4090, 4100)],
             *[(602, t, "user", f"m{t}") for t in range(4090, 4096)], *[(603, t, "user", f"m{t}") for t in range(4090, 4105)]]
    df = spark.createDataFrame([(*r, 9, True) for r in rows], "conv_id bigint, turn bigint, role string, text string, "
                               "part int, more boolean").repartition(5)
    got = chat.maximal_conversations(df)
    assert sorted(map(tuple, got.select("conv_id", "part", "n_turns", "text").collect())) == run_sql(rows)
    assert {r.conv_id for r in got.collect()} & {600, 601, 602, 603, 501, 502} == {600, 501}  # repeated rows of 501 are one turn, as in 502
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_chat_null_ids_and_empty(spark):
    schema = "conv_id bigint, turn int, role string, text string"
    rows = [(None, 0, "user", "a"), (None, 1, "user", "b"), (None, 5, "user", "b"), (1, 0, "user", "a")]
    got = chat.maximal_conversations(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, got), key=repr) == [(1, 0, 1, "<|user|>\na\n"), (None, 0, 1, "<|user|>\nb\n")] and run_sql(
        rows, repr) == sorted(map(tuple, got), key=repr)
    assert chat.maximal_conversations(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("name", ["op6_chat_collapse"])
def test_sql_on_test_tables(spark, name):
    import __spark_entry__ as E
    got = sorted(map(tuple, E.queries()[name](spark, SF_SMALL).select("conv_id", "part", "n_turns", "text").collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF_SMALL}/conversations.parquet')")
    assert got == sorted(con.execute(E.oracle_sql()[name]).fetchall())


def test_all_trusted_documents_count(spark):
    docs = spark.range(20_500).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 7).alias("text"))
    assert set(importance.log_ratios(docs, docs.select("doc_id"), buckets=50)) == {0.0}  # both sides are the same


def test_long_and_hot_conversations_split(spark):
    """A third of the rows without id, one turn said by 100,000 conversations, one conversation of 9,000 turns of one number."""
    many = spark.range(100_000).select((F.col("id") + 10).alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"),
                                       F.lit("hello").alias("text"))
    alone = spark.range(60_000).select(F.lit(None).cast("bigint").alias("conv_id"), (F.col("id") % 3).cast("int").alias("turn"),
                                       F.lit("user").alias("role"), F.concat(F.lit("m"), F.col("id") % 20_000).alias("text"))
    long = spark.range(9_000).select(F.lit(1).cast("bigint").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"),
                                     F.lpad(F.col("id").cast("string"), 5, "0").alias("text"))
    got = chat.maximal_conversations(many.unionAll(alone).unionAll(long).repartition(8))
    by_id = {r.conv_id: r for r in got.where("conv_id <> 1").collect()}
    assert list(by_id) == [10] and got.where("conv_id IS NULL").count() == 20_000
    parts = sorted((r.part, r.n_turns, r.text) for r in got.where("conv_id = 1").collect())
    assert [p[:2] for p in parts] == [(0, 4096), (1, 4096), (2, 808)]
    assert "".join(p[2] for p in parts) == "".join(f"<|user|>\n{k:05d}\n" for k in range(9_000))
