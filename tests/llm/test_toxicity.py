"""Toxicity: decoding against all paths, counts against a plain computation, held-out accuracy, obfuscated words."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from encore.llm import toxicity as X

SF = "/root/testdata/sf0.1"


def plain_trigrams(texts):
    n = {}
    for t in texts:
        for word in re.findall(f"[{X.LETTERS}]+", t.lower()):
            codes = [0, 0, *(X.LETTERS.index(c) + 1 for c in word), 0]
            for k in range(2, len(codes)):
                key = (codes[k - 2] * 64 + codes[k - 1]) * 64 + codes[k]
                n[key] = n.get(key, 0) + 1
    return n


def test_trigram_counts():
    texts = ["Abc abÿ, x÷y\n\n", "", "ÀB a", "日本 abc 1a2"]
    got = X.trigram_counts([t.lower() for t in texts])
    assert {int(k): int(got[k]) for k in np.flatnonzero(got)} == plain_trigrams(texts)


def model_of(texts):
    rng = np.random.default_rng(1)
    n = np.zeros(64 ** 3) + rng.random(64 ** 3) * 0.01
    for k, v in plain_trigrams(texts).items():
        n[k] += v
    n = n.reshape(64, 64, 64)
    return np.log((n + 0.05) / (n + 0.05).sum(-1, keepdims=True))


def all_paths(model, span):
    """Best (log probability, words) over every path of the channel, one by one."""
    arcs, spaced = X._arcs(), X._SPACED.fullmatch(span)
    within, end = X.SPACED if spaced else X.PLAIN
    best = [(-math.inf, None)]

    def go(i, a, b, p, out):
        if i == len(span):
            p += model[a, b, 0] if b else 0
            if p > best[0][0]:
                best[0] = (p, out)
            return
        ch = span[i]
        for c, cost in arcs.get(ch, ()):
            go(i + 1, b, c, p + cost + model[a, b, c], out + X.LETTERS[c - 1])
            if i and ch == span[i - 1] and c == b:
                go(i + 1, a, b, p + X.REPEAT, out)
        if ch not in X._CODE:
            if b:
                go(i + 1, a, b, p + (X.IDLE if ch in arcs else within), out)
                go(i + 1, 0, 0, p + model[a, b, 0] + (X.SIGN if ch in arcs else end), out + " ")
            else:
                go(i + 1, 0, 0, p, out)
    go(0, 0, 0, 0.0, "")
    return best[0][1].split()


def test_decoding_is_the_best_of_all_paths():
    model = model_of(["the idiot met a moron", "clown stupid clown a he", "scum idiot"] * 20)
    keep, rng = X.Restorer(model), random.Random(3)
    for _ in range(300):
        span = "".join(rng.choices("idotam01!|$ .-s@", k=rng.randrange(1, 8)))
        assert keep.decode(span) == all_paths(model, span), span
    assert keep.decode("1d10t") == ["idiot"] and keep.decode("m o r o n") == ["moron"] and keep.word("iiidioooot!!") == ["idiot"]
    assert keep.word("idiot,") == ["idiot"] and keep.word("日本") == ["日本"] and keep.word("!!") == [] and keep.decode("") == []


def disguise(word, rng):
    kind = rng.randrange(4)
    if kind == 0:
        return " ".join(word)
    if kind == 1:
        k = rng.randrange(len(word))
        return word[:k] + word[k] * 4 + word[k + 1:]
    if kind == 2:
        return ".".join(word)
    sign = {"o": "0", "i": "1", "e": "3", "a": "@", "s": "$", "t": "7", "l": "1"}
    k = rng.choice([k for k, c in enumerate(word) if c in sign] or [None])
    return word if k is None else word[:k] + sign[word[k]] + word[k + 1:]


def test_held_out_accuracy_and_disguised_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = labels.toPandas().set_index("doc_id").toxic.to_dict()
    words = "idiot moron loser trash stupid pathetic clown scum disgusting worthless".split()
    plain, rng, extra, clean = re.compile(rf"\b({'|'.join(words)})\b", re.I), random.Random(8), [], []
    for doc, text, lang in zip(docs.doc_id, docs.text, docs.lang):
        if lang != "en" or zlib.crc32(str(doc).encode()) % 3 != 1:
            continue
        if known.get(doc) == 1 and plain.search(text):
            extra.append((10 ** 9 + doc, plain.sub(lambda m: disguise(m.group().lower(), rng), text)))
        elif known.get(doc) == 0:  # plain words in disguise do no harm
            ws = text.split(" ")
            for k in rng.sample(range(len(ws)), min(3, len(ws))):
                ws[k] = disguise(ws[k], rng) if ws[k].isalpha() else ws[k]
            clean.append((2 * 10 ** 9 + doc, " ".join(ws)))
    rows = list(zip(docs.doc_id.tolist(), docs.text.tolist())) + extra + clean
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    got = {r.doc_id: r for r in X.toxicity(df, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
               for d, r in got.items())
    held = {d: t for d, t in known.items() if got[d].held_out}
    rate = {t: np.mean([got[d].predicted for d, x in held.items() if x == t]) for t in (0, 1)}
    assert rate[1] > 0.8 and rate[0] < 0.01
    assert len(extra) > 50 and np.mean([got[d].predicted for d, _ in extra]) > 0.85
    assert np.mean([got[d].predicted for d, _ in clean]) < 0.02


def test_nulls_empty_long_and_extra_columns(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "you idiot", 1), (3, "ab " * 50_000 + "x" * 100_000, 1), (4, "1" * 5000 + "a", 1), (1, None, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, score int")
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id bigint, toxic int")
    got = X.toxicity(df, labels).collect()
    assert len(got) == 6 and {round(r.score, 3) for r in got} == {0.0} and not any(r.predicted for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert X.toxicity(df.limit(0), labels).count() == 0


def test_features_are_learned_from_training_rows_only(spark):
    from pyspark.sql import functions as F
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(
        F.when(F.crc32(F.col("id").cast("string")) % 3 == 1, "heldword").otherwise("trainword"), F.lit(" body")).alias("text"),
        (F.col("id") % 2).alias("toxic")).withColumn("text", F.when(F.col("toxic") == 1, F.col("text")).otherwise("body"))
    got = X.toxicity(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    rate = {(r.held_out, r.toxic): r.p for r in got.join(docs.select("doc_id", "toxic"), "doc_id").groupBy("held_out", "toxic").agg(
        F.avg("predicted").alias("p")).collect()}
    assert rate == {(False, 1): 1.0, (False, 0): 0.0, (True, 1): 0.0, (True, 0): 0.0}


def test_tie_at_the_threshold_is_toxic(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    score = X.toxicity(df, none).first().score
    assert X.toxicity(df, none, threshold=score).first().predicted == 1


@pytest.mark.parametrize("toxic, width", [([1, 0, 1, 0], 1)])
def test_fit_separates(toxic, width):
    w = X.fit([[0], [], [0], []], np.array(toxic), np.ones(4), width, penalty=0.01)
    assert w[0] + w[1] > 2 and w[1] < -2
