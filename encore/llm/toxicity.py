"""Toxicity by noisy-channel deobfuscation: texts are restored letter by letter, then scored.

What was written is taken as what was meant sent through a channel that
writes letters as look-alike signs (leetspeak), repeats them and puts signs or
spaces between them.  Words that show any of this span a lattice of the
letters each sign may stand for, of dropped signs, repetitions and word ends;
Viterbi decoding finds the most probable path under a character trigram model
of all documents.  Other words stay as they are.

The restored text is scored by the words and word beginnings in it: the ones
most bound to toxic texts (by the log-likelihood ratio of document counts) are
weighted by logistic regression.  Selection and weights come from at most
``MAX_TOXIC`` and ``MAX_CLEAN`` labelled training documents.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .storage import drop, stage_path, staged

#: Labelled training documents that the classifier is fitted on, by hash of doc_id.
MAX_TOXIC, MAX_CLEAN = 4_000, 8_000
#: Words and word beginnings that are weighted, and the lengths of beginnings.
MAX_FEATURES, BEGINNINGS = 600, range(2, 9)
THRESHOLD = 0.7

#: Letters of the character model: a-z, then the small letters of U+00DF to U+00FF; 0 ends a word.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
_CODE = {ch: k + 1 for k, ch in enumerate(LETTERS)}
_BASE = 64
#: What a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a",
        "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou"}
#: Log probabilities of the channel: a sign for a letter, one more repetition, a look-alike that means nothing.
SIGN, REPEAT, IDLE = -3.0, -2.0, -6.0
#: Any other sign or space, within a word and at its end: in words as they stand, and where every letter stands alone.
PLAIN, SPACED = (-3.0, 0.0), (-0.5, -4.0)
#: Least log-likelihood gain of a feature: exp(-14) of the features would reach it by chance.
MIN_GAIN = 14.0

_LETTER = "a-zß-öø-ÿ"
_ODD = re.compile(rf"[^{_LETTER}]|(.)\1\1")
_SIGNS_AT_ENDS = re.compile(rf"^([^{_LETTER}0-9])\1+|([^{_LETTER}0-9])\2+$")
_ENDS = ".,;:?!\"'()[]{}<>*_-~`^&%#=/\\"
#: Three or more single characters with spaces or signs between them.
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t._*-]\S){2,}(?!\S)")


# ----------------------------------------------------------------- character model
_LOOKUP = np.zeros(0x100, np.uint32)
for _ch, _k in _CODE.items():
    _LOOKUP[ord(_ch)] = _k


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of (letter before last, last, next) over the words of lower-cased texts; contexts begin with the word."""
    points = np.frombuffer("\n\n".join([*texts, ""]).encode("utf-32-le"), np.uint32)
    code = np.concatenate([[0, 0], _LOOKUP[np.minimum(points, 0xFF)] * (points < 0x100)]).astype(np.int64)
    last, nxt = code[1:-1], code[2:]
    seen = (last != 0) | (nxt != 0)
    index = (np.where(last == 0, 0, code[:-2]) * _BASE + last) * _BASE + nxt
    return np.bincount(index[seen], minlength=_BASE ** 3)


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(next | two before) from the texts of all documents; its size is that of the alphabet cubed."""
    def run(batches):
        total = np.zeros(_BASE ** 3, np.int64)
        for b in tx.slices(batches, 0):
            total += trigram_counts([t.lower() for t in b.column(0).to_pylist()])
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], ["tri", "n"])

    rows = docs.select("text").mapInArrow(run, "tri bigint, n bigint").groupBy("tri").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(_BASE ** 3)
    for r in rows:
        n[r.tri] = r.n
    tri = n.reshape(_BASE, _BASE, _BASE)
    letters = len(LETTERS) + 1
    lower = (tri.sum((0, 1)) + 1) / (tri.sum() + letters)  # each order backs off to the one below by its kinds of successors
    for counts in (tri.sum(0), tri):
        kinds = (counts > 0).sum(-1, keepdims=True)
        lower = (counts + kinds * lower) / np.maximum(counts.sum(-1, keepdims=True) + kinds, 1) + (kinds == 0) * lower
    return np.log(np.maximum(lower, 1e-12))


# ----------------------------------------------------------------- decoding
def _arcs() -> dict[str, list[tuple[int, float]]]:
    arcs = {ch: [(k, 0.0)] for ch, k in _CODE.items()}
    return arcs | {sign: [(_CODE[ch], SIGN) for ch in meant] for sign, meant in LEET.items()}


class Restorer:
    """Words as they were meant; distinct words are remembered, a bounded number of them."""

    def __init__(self, model: np.ndarray):
        self.model = model.reshape(_BASE * _BASE, _BASE).tolist()
        self.arcs = _arcs()
        self.words = tx.Cached(self.word, 100_000)

    def decode(self, span: str) -> list[str]:
        """The most probable words behind ``span``, by Viterbi over (letter before last, last)."""
        states, before = {(0, 0): (0.0, None)}, ""
        within, end = SPACED if _SPACED.fullmatch(span) else PLAIN
        for ch in span:
            arcs, step = self.arcs.get(ch, ()), {}

            def reach(state, p, out):
                if state not in step or p > step[state][0]:
                    step[state] = (p, out)

            for (a, b), (p, out) in states.items():
                after = self.model[a * _BASE + b]
                for c, cost in arcs:
                    reach((b, c), p + cost + after[c], (out, c))
                    if ch == before and c == b:
                        reach((a, b), p + REPEAT, out)
                if ch not in _CODE:
                    if b:
                        reach((a, b), p + (IDLE if arcs else within), out)
                        reach((0, 0), p + after[0] + (SIGN if arcs else end), (out, 0))
                    else:
                        reach((0, 0), p, out)
            states, before = step, ch
        _, out = max((p + (self.model[a * _BASE + b][0] if b else 0.0), n, out)
                     for n, ((a, b), (p, out)) in enumerate(states.items()))[1:]
        codes = []
        while out:
            out, c = out
            codes.append(c)
        return "".join(LETTERS[c - 1] if c else " " for c in reversed(codes)).split()

    def word(self, token: str) -> list[str]:
        core = token.strip(_ENDS)
        if _ODD.search(core):
            core = _SIGNS_AT_ENDS.sub("", core).strip(_ENDS)
            if _ODD.search(core) and any(ch in _CODE for ch in core):
                return self.decode(core)
        return [core] if core else []

    def restored(self, text: str) -> set[str]:
        """The distinct words of the restored text."""
        low = text.lower()
        tokens, words = set(low.split()), set()
        for span in _SPACED.finditer(low):
            words.update(self.decode(span.group()))
        for t in tokens:
            words.update(self.words[t])
        return words


def features(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word[:k] for k in BEGINNINGS if k < len(word)] + [word + " "]


# ----------------------------------------------------------------- classifier
def fit(rows: list[list[int]], toxic: np.ndarray, weight: np.ndarray, width: int, penalty: float = 0.3) -> np.ndarray:
    """Weights (the last: bias) of a penalised logistic regression over sets of features, by Newton steps."""
    x = np.zeros((len(rows), width + 1), np.float32)
    for k, own in enumerate(rows):
        x[k, own] = 1
    x[:, -1] = 1
    # Documents with the same features are one row; most have none.
    x, back = np.unique(x, axis=0, return_inverse=True)
    pos = np.bincount(back.ravel(), weight * toxic, len(x))
    n = np.bincount(back.ravel(), weight, len(x))
    w, ridge = np.zeros(width + 1), np.full(width + 1, penalty)
    ridge[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * p - pos) + ridge * w
        curve = (x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(curve, slope)
        w -= move * min(1.0, 5 / max(np.abs(move).max(), 1e-9))
        if np.abs(move).max() < 1e-5:
            break
    return w


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict]:
    """(text, toxic) of the labelled training documents fitted on, and how many labelled ones each stands for."""
    train = labels.where((F.crc32(F.col("doc_id").cast("string")) % 3 != 1) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    total = {r.toxic: r.n for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = {0: MAX_CLEAN, 1: MAX_TOXIC}
    ids = [train.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in most.items()]
    # At most MAX_TOXIC + MAX_CLEAN ids.
    picked = docs.join(F.broadcast(ids[0].union(ids[1])), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min("text").alias("text")).select("text", "toxic")
    return picked, {k: max(1.0, total.get(k, 0) / n) for k, n in most.items()}


def train(docs: DataFrame, labels: DataFrame, model: np.ndarray) -> tuple[dict[str, float], float]:
    """(weight of each feature, bias); without toxic training documents no feature and a bias for none."""
    spark, key = docs.sparkSession, uuid.uuid4().hex
    sent = spark.sparkContext.broadcast(model)
    picked, stands_for = _sample(docs, labels)

    def restore(batches):
        keep = tx.per_worker(("restorer", key), lambda: Restorer(sent.value))
        for b in tx.slices(batches, 0):
            yield pa.RecordBatch.from_arrays(
                [pa.array([sorted(keep.restored(t)) for t in b.column(0).to_pylist()], pa.list_(pa.string())), b.column(1)],
                ["words", "toxic"])

    path = stage_path(spark, "toxicity-words")
    words = staged(picked.mapInArrow(restore, "words array<string>, toxic int"), "toxicity-words", path)

    def count(batches):
        for b in batches:
            seen = [Counter(), Counter()]
            for ws, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen[toxic].update({f for w in ws for f in features(w)})
            for toxic, found in enumerate(seen):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.string()), pa.array([toxic] * len(found), pa.int32()),
                     pa.array(list(found.values()), pa.int64())], ["feature", "toxic", "n"])

    n = {r.toxic: r.n for r in words.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = n.get(0, 0), n.get(1, 0)
    if not clean or not toxic:
        drop(spark, path)
        return {}, 10.0 if toxic else -10.0
    found = words.mapInArrow(count, "feature string, toxic int, n bigint").groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c")).where(
        (F.col("t") > 1) & (F.col("t") * clean > F.col("c") * toxic))

    def part(k: str, of: int) -> str:  # observed * log(observed / expected) of documents with the feature
        return f"IF({k} = 0, 0, {k} * ln({k} / ((t + c) * {of} / {clean + toxic}D)))"

    best = found.withColumn("bound", F.expr(f"{part('t', toxic)} + {part('c', clean)}")).where(
        F.col("bound") >= MIN_GAIN).orderBy(
        F.desc("bound"), "feature").limit(MAX_FEATURES).collect()
    index = {r.feature: k for k, r in enumerate(best)}
    held = spark.sparkContext.broadcast(index)

    def pick(batches):
        for b in batches:
            own = [sorted({held.value[f] for w in ws for f in features(w) if f in held.value}) for ws in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32())), b.column(1)], ["own", "toxic"])

    rows = words.mapInArrow(pick, "own array<int>, toxic int").collect()
    drop(spark, path)
    label = np.array([r.toxic for r in rows])
    w = fit([r.own for r in rows], label, np.where(label == 1, stands_for[1], stands_for[0]), len(index))
    return {f: float(w[k]) for f, k in index.items()}, float(w[-1])


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    ``labels`` (doc_id, toxic) names toxic texts; only rows whose id's crc32
    leaves no remainder of 1 by 3 are learned from, of rows that share an id
    any toxic one decides.  Null and empty texts have the score of a text
    without features.  Whole texts are restored and scored, of any length;
    repeated rows and null ids (never held out or labelled) get a row each;
    ties at the threshold are toxic.  Other columns are ignored; an empty
    table gives an empty result.
    """
    spark, key = docs.sparkSession, uuid.uuid4().hex
    src = tx.id_text(docs, id_col, text_col)
    model = character_model(src)
    weights, bias = train(src, labels.select("doc_id", "toxic"), model)
    sent = spark.sparkContext.broadcast((model, weights, bias))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        model, weights, bias = sent.value

        def load():
            keep = Restorer(model)
            return keep, tx.Cached(lambda t: [f for w in keep.word(t) for f in features(w) if f in weights], 300_000)
        keep, found = tx.per_worker(("toxicity", key), load)
        for b in tx.slices(batches, 1):
            scores = []
            for t in b.column(1).to_pylist():
                low = t.lower()
                own = set()
                for token in set(low.split()):
                    own.update(found[token])
                for span in _SPACED.finditer(low):
                    own.update(f for w in keep.decode(span.group()) for f in features(w) if f in weights)
                z = bias + sum(sorted(weights[f] for f in own))
                scores.append(1 / (1 + np.exp(-z)) if z > -500 else 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return src.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
