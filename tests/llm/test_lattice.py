"""Lattice sums against listing every segmentation; scores against a plain computation."""

import math
import random
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from encore.llm import lattice

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def segmentations(s, pieces):
    if not s:
        yield []
        return
    singles = s[0] in pieces
    for j in range(1, len(s) + 1):
        if s[:j] in pieces:
            for rest in segmentations(s[j:], pieces):
                yield [s[:j], *rest]
    if not singles:
        for rest in segmentations(s[1:], pieces):
            yield [f"<0x{b:02X}>" for b in s[0].encode()] + rest


def small():
    pieces = ["▁", "▁a", "a", "ab", "b", "ba", "abab", "▁abc", "é", "c", "xyz"] + [f"<0x{b:02X}>" for b in range(256)]
    rng = random.Random(1)
    return pieces, {p: math.log(rng.random() / 50) for p in pieces}


@pytest.mark.parametrize("word", ["a", "abab", "abéab", "ababcc", "x", "xyzq", "xy", "日a", "zzz"])
def test_forward_and_expectation_equal_listing(word):
    pieces, logs = small()
    model = lattice.Lattice(logs)
    every = [(seg, math.exp(sum(logs[p] for p in seg))) for seg in segmentations("▁" + word, set(pieces) - {
        p for p in pieces if lattice._is_byte(p)})]
    total = sum(p for _, p in every)
    others = [b"ab", b"q", b"a" * 30]
    assert model.words([*others, word.encode()])[-1] == pytest.approx(math.log10(total))
    got, want = Counter(), Counter()
    model.expect([word.encode(), *others], [3, 0, 0, 0], got)
    got = Counter({k: x for k, x in got.items() if x})
    for seg, p in every:
        for piece in seg:
            want[piece] += 3 * p / total
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def plain(rows, rounds):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    words = [(t or "").encode().lower().split() for _, t in rows]
    c = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    ends = held.count(False)
    n_all, v = sum(c.values()) + ends, len(c) + (ends > 0)
    with open(MODEL, "rb") as f:
        model = f.read()
    vocabulary, sp = lattice._vocabulary(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    counts = Counter()
    for w, n in c.items():
        for p in sp.encode(w.decode(), out_type=str):
            counts[p] += n
    probs = lattice._log_probs(vocabulary, counts, ends)
    for _ in range(rounds):
        counts, model = Counter(), lattice.Lattice(probs)
        model.expect(list(c), list(c.values()), counts)
        probs = lattice._log_probs(vocabulary, counts, ends)
    assert math.fsum(map(math.exp, probs.values())) == pytest.approx(1)
    model = lattice.Lattice(probs)
    out = []
    for (d, _), ws, h in zip(rows, words, held):
        base = sum(math.log10((c[w] + 1) / (n_all + v + 1)) for w in ws) + math.log10((ends + 1) / (n_all + v + 1))
        out.append((d, h, len(ws) + 1, sum(c[w] > 0 for w in ws) + (ends > 0), n_all, round(base, 6),
                    round(sum(model.words(ws)) + probs[lattice.END] / math.log(10), 6)))
    return out


def test_scores_equal_plain_computation(spark):
    rng = random.Random(2)
    vocab = ["The", "the", "of", "théa", "ßx", "日本", "a\x1cb", "ing", "!!", "x" * 300] + [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randrange(60)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " \n"), (None, "the of"), (5, "the the"), (5, "the the")]
    df = spark.createDataFrame([(*r, "clash", 1, 2.0) for r in rows],
                               "doc_id bigint, text string, word string, c int, score double").repartition(3)
    got = lattice.scores(df, MODEL, rounds=2, hot=0.02)
    out = [(*r[:5], round(r[5], 6), round(r[6], 6)) for r in got.collect()]
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    key = lambda r: (r[0] is None, r[0] or 0, r)
    assert [x[:5] for x in sorted(out, key=key)] == [x[:5] for x in sorted(plain(rows, 2), key=key)]
    for x, y in zip(sorted(out, key=key), sorted(plain(rows, 2), key=key)):
        assert x[5:] == pytest.approx(y[5:], abs=2e-5)


def test_rounds_raise_held_out_likelihood(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = [sum(r.score for r in lattice.scores(docs, MODEL, rounds=n).where("held_out").collect()) for n in (0, 2)]
    assert held[1] > held[0]


def test_scores_empty(spark):
    assert lattice.scores(spark.createDataFrame([], "doc_id bigint, text string"), MODEL).count() == 0
