"""Kneser-Ney perplexities against a plain computation over dictionaries; verdicts against labels."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from encore.llm import kneser_ney as K


class Plain:
    """Interpolated modified Kneser-Ney, order 3, by definition."""

    def __init__(self, texts):
        tri = Counter()
        for t in texts:
            ws = ["<s>", "<s>", *t.lower().split(), "</s>"]
            tri.update(zip(ws, ws[1:], ws[2:]))
        bi = Counter((b, c) for _, b, c in tri)
        uni = Counter(c for _, c in bi)
        self.levels = [self.level({(k,): n for k, n in uni.items()}), self.level(bi), self.level(tri)]
        self.v = len(uni)

    @staticmethod
    def level(counts):
        m = Counter(counts.values())
        y = m[1] / (m[1] + 2 * m[2]) if m[1] + m[2] else 0.5
        d = [1 - 2 * y * m[2] / m[1] if m[1] else 0.5, 2 - 3 * y * m[3] / m[2] if m[2] else 1.0,
             3 - 4 * y * m[4] / m[3] if m[3] else 1.5]
        d = [min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1)]
        total, cut = defaultdict(int), defaultdict(float)
        for g, n in counts.items():
            total[g[:-1]] += n
            cut[g[:-1]] += d[min(n, 3) - 1]
        return counts, total, cut, d

    def p(self, gram):
        if not gram:
            return 1 / (self.v + 1)
        counts, total, cut, d = self.levels[len(gram) - 1]
        ctx, lower = gram[:-1], self.p(gram[1:])
        if ctx not in total:
            return lower
        n = counts.get(gram, 0)
        return (n - d[min(n, 3) - 1] if n else 0) / total[ctx] + cut[ctx] / total[ctx] * lower

    def perplexity(self, text):
        ws = ["<s>", "<s>", *(text or "").lower().split(), "</s>"]
        logs = [math.log(self.p(tuple(ws[i - 2:i + 1]))) for i in range(2, len(ws))]
        return len(logs), math.exp(-sum(logs) / len(logs))


def corpus(n=120):
    rng = random.Random(3)
    vocab, weights = [f"w{i}" for i in range(60)], [1 / (i + 1) for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocab, weights, k=rng.randrange(1, 60))), rng.choice(["en", "de", None])) for i in range(n)]
    junk = [(n + i, " ".join(f"%%{rng.random()}" for _ in range(30)), "en") for i in range(5)]
    return rows, rows + junk + [(9000, None, "fr"), (9001, "", "fr"), (None, "w1 w2", "de"), (3, "w1 w2 w1", "en")]


def test_perplexities_equal_plain_computation(spark):
    train, rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    model = K.train(df.where(f"doc_id < {len(train)} AND text <> 'w1 w2 w1'").select("text"), shard=37)
    assert len(model["tri"]) > 3
    plain = Plain([t for _, t, _ in train])
    assert sum(plain.p(("w1", "w2", w)) for w in [f"w{i}" for i in range(60)] + ["</s>", "<unk>"]) == pytest.approx(1, abs=1e-6)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    src = df.withColumn("text", F.coalesce("text", F.lit("")))
    got = sorted(((r.doc_id, r.n_tokens, r.perplexity) for r in K.perplexities(src, model).collect()), key=key)
    want = sorted(((d, *plain.perplexity(t)) for d, t, _ in rows), key=key)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-5)


def test_quantiles_by_language(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["en", "de", None]), math.exp(rng.random() * 5)) for _ in range(500)] + [("xx", 5.0)]
    got = {r.lang: r.threshold for r in K.quantiles(spark.createDataFrame(rows, "lang string, perplexity double"), 0.9, 30).collect()}
    assert set(got) == {"en", "de", "?", ""}
    for lang, own in (("en", [p for l, p in rows if l == "en"]), ("?", [p for l, p in rows if l is None]), ("", [p for _, p in rows])):
        exact = sorted(own)[math.ceil(0.9 * len(own)) - 1]
        assert exact <= got[lang] <= exact * math.exp(2 * K.STEP)


def test_training_words_are_bounded(spark):
    _, rows = corpus()
    src = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").fillna("", ["text"])
    ids = src.select("doc_id")
    texts = [r.text for r in K.training_texts(src, ids, max_docs=1000, max_words=200).collect()]
    assert texts and sum(len(t.split()) for t in texts) <= 200
    assert K.training_texts(src, ids, max_docs=4).count() <= 4 + 1  # one id has two rows


def test_joined_perplexities_equal_plain_computation(spark):
    train, rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3).fillna("", ["text"])
    docs = df.where(f"doc_id < {len(train)} AND text <> 'w1 w2 w1'").select("text")
    assert K.model_entries(docs, 37)[1]["buckets"] > 3
    plain = Plain([t for _, t, _ in train])
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r.doc_id, r.n_tokens, r.perplexity) for r in K.perplexities_joined(df, docs, size=37).collect()), key=key)
    want = sorted(((d, *plain.perplexity(t)) for d, t, _ in rows), key=key)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-5)


def test_model_learns_from_every_trusted_text_of_its_half(spark):
    df = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    want = df.where(K._half(F.col("doc_id")) == 0).count()
    assert want > 20_000 and K.training_texts(df, df.select("doc_id")).count() == want
    long = spark.createDataFrame([(i, "w " * 600_000) for i in range(8)], "doc_id bigint, text string")
    assert K.training_texts(long, long.select("doc_id")).count() == long.where(K._half(F.col("doc_id")) == 0).count()


def test_quality_separates_labels_and_handles_odd_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(None, None, None, "s", 0), (-1, "", None, "s", 0), (-1, "x", "zz", "s", 0)], docs.schema)
    docs = docs.unionByName(odd).withColumn("threshold", F.lit("clash"))
    got = K.quality(docs, labels.where("quality = 1 AND toxic = 0").select("doc_id"))
    assert got.count() == docs.count()
    rate = {r.quality: r.k for r in got.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert rate[1] > 0.95 and rate[0] < 0.5


def test_quality_without_trusted_or_rows(spark):
    df = spark.createDataFrame([(1, "a b", "en"), (2, None, None)], "doc_id bigint, text string, lang string")
    got = K.quality(df, df.where("false").select("doc_id")).collect()
    assert len(got) == 2 and all(r.kept for r in got)
    assert K.quality(df.where("false"), df.select("doc_id")).count() == 0


def test_shards_find_every_key():
    keys = np.unique(np.random.default_rng(4).integers(0, 2**64, 5000, np.uint64))
    table = K.shards(keys, np.arange(len(keys), dtype=np.float32), 700)
    assert len(table) > 5 and (K.joined(keys, table, -1) == np.arange(len(keys))).all()
    assert (K.joined(keys + np.uint64(1), table, -1) == -1).sum() > 4900


def test_words_are_cut_as_bytes_split_does():
    rng = random.Random(5)
    texts = ["".join(rng.choice("aAbBcÉé \t\n\r\x0b\x0c\x1c\x85 ") for _ in range(rng.choice([0, 1, 5, 60, 400]))).encode() for _ in range(500)]
    texts += [b"x" * (3 * K.AT_ONCE) + b" y " + b"z " * K.AT_ONCE, b"", b" ", b"ab", b"cd"]
    for arr in (pa.array(texts, pa.binary()), pa.array([b"left out", *texts], pa.binary()).slice(1), pa.array(texts, pa.large_binary())):
        hashes, sizes = K._hashes(arr)
        assert sizes.tolist() == [len(t.split()) for t in texts]
        words = [w for t in texts for w in t.lower().split()]
        assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))
    assert K._hashes(pa.array(["", ""]))[1].tolist() == [0, 0] and not len(K._hashes(pa.array([], pa.string()))[1])


def test_the_filter_rules_out_no_entry_and_every_entry_is_found():
    rng = np.random.default_rng(6)
    keys, buckets, bits = rng.integers(0, 2**64, 4000, np.uint64), 7, 800
    held = np.zeros((buckets, bits), bool)
    held[keys % np.uint64(buckets), K._bit(keys, bits)] = True
    held = np.packbits(held, axis=1)
    others = rng.integers(0, 2**64, 4000, np.uint64)
    assert len(K._maybe(keys, held)) == 4000 and 1000 < len(K._maybe(others, held)) < 3500
    values = rng.random(4000)
    hit, got = K._found(K._table(keys.tobytes(), values.tobytes()), np.concatenate([others, keys, [np.uint64(0), ~np.uint64(0)]]))
    assert (hit == np.arange(4000, 8000)).all() and (got == values).all()
    assert not len(K._found(K._table(b"", b""), keys)[0])


def test_only_a_pass_of_the_model_is_on_disk(spark, monkeypatch):
    train, rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3).fillna("", ["text"])
    docs = df.where(f"doc_id < {len(train)}").select("text")
    wrote, kept, write, drop = [], [], K.staged, K.drop

    def staged(out, name, *more):
        wrote.append((name, out.columns))
        kept.extend(more[:1])
        return write(out, name, *more)

    monkeypatch.setattr(K, "staged", staged)
    monkeypatch.setattr(K, "drop", lambda s, path: (kept.remove(path), drop(s, path)))
    assert K.perplexities_joined(df, docs, size=200).count() == len(rows)
    passes = [columns for name, columns in wrote if name == "sums"]
    assert len(passes) > 3 and not kept and all(c == ["file", "at", "log"] for c in passes)
    assert not any("text" in columns for name, columns in wrote if name not in ("training", "placed"))
