"""Repeated paragraphs against brute force over exact similarities."""

import itertools
import random

import time

import numpy as np
from pyspark.sql import functions as F

from encore.llm import paragraphs as P


def brute(docs, similarity=0.8):
    units, size = {}, {}
    for d, t in docs:
        for k, (_, ws) in enumerate(P.paragraphs((t or "").encode().lower())):
            if len(ws) >= P.MIN_WORDS:
                units[(d, k)] = frozenset(zip(*(ws[i:] for i in range(5))))
                size[(d, k)] = len(ws)
    keys = sorted(units)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a, b in itertools.combinations(keys, 2):
        x, y = units[a], units[b]
        if len(x & y) >= similarity * len(x | y):
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    groups = {}
    for k in keys:
        groups.setdefault(find(k), []).append(k)
    kept = {k: r for r, ks in groups.items() if len(ks) > 1 for k in ks}

    def run(k):  # words of the repeated paragraphs in a row around k
        total = size[k]
        for step in (-1, 1):
            n = k[1] + step
            while (k[0], n) in kept:
                total += size[(k[0], n)]
                n += step
        return total
    return {(k, r, k != r) for k, r in kept.items() if run(k) >= 16}


def corpus(seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=4))
    sentence = lambda n: " ".join(word() for _ in range(n)) + "."
    long = [sentence(rng.randrange(25, 70)) for _ in range(12)]
    docs = [None, "", " \n ", "The.\nThe.", "a b c"]
    for _ in range(60):
        parts = [sentence(rng.randrange(1, 30)) for _ in range(rng.randrange(6))]
        for p in rng.sample(long, 2):
            ws = p.split(" ")
            if rng.random() < 0.4:
                ws[rng.randrange(len(ws) - 1)] = "changed"
            parts.insert(rng.randrange(len(parts) + 1), " ".join(ws))
        docs.append(rng.choice([" ", "\n", "\n\n"]).join(parts))
    return list(enumerate(docs))


def test_paragraph_ends_cover_the_text():
    for _, t in corpus():
        t = (t or "").encode()
        ends = [e for e, _ in P.paragraphs(t)]
        assert ends == sorted(set(ends)) and (ends[-1] if ends else 0) == len(t)
        assert [w for _, ws in P.paragraphs(t) for w in ws] == t.split()
        assert P.without_paragraphs(t, set()) == t


def test_repeated_paragraphs_equal_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id bigint, text string, content string, band int")
    got = {((r.doc_id, r.paragraph), (r.kept_doc_id, r.kept_paragraph), r.removed)
           for r in P.repeated_paragraphs(df.repartition(4)).collect()}
    want = brute(docs)
    exact = {x for x in brute(docs, 1.0)}
    assert {k for k, _, _ in exact} <= {k for k, _, _ in got}  # no exact copy is missed
    assert {k for k, _, _ in got} <= {k for k, _, _ in want}
    assert len(got) >= 0.97 * len(want)


def test_all_lists_give_exact_links(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 3)
    monkeypatch.setattr(P, "FINER", ())
    docs = corpus(5)
    units = [(i, b" ".join(ws)) for i, ws in enumerate(
        w for _, t in docs for _, w in P.paragraphs((t or "").encode()) if len(w) >= P.MIN_WORDS)]
    lists = spark.createDataFrame([(1, i, len(units)) for i, _ in units], "band bigint, content bigint, members bigint")
    texts = spark.createDataFrame(units, "content bigint, words binary")
    got = {tuple(sorted(r)) for r in P._links(lists, texts, 0.8).collect()}
    sets = {i: P.shingles(w) for i, w in units}
    near = {(a, b) for a, b in itertools.combinations(sorted(sets), 2)
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert got <= near

    def roots(edges):
        root = {i: i for i in sets}

        def find(i):
            while root[i] != i:
                i = root[i]
            return i
        for a, b in edges:
            root[find(a)] = find(b)
        return sorted(sorted(i for i in sets if find(i) == r) for r in {find(i) for i in sets})
    assert roots(got) == roots(near)


def test_band_recall_at_the_threshold():
    rng, hit = random.Random(1), 0
    for _ in range(400):
        ws = [str(rng.random()).encode() for _ in range(49)]
        other = ws[:44] + [b"x%d" % i for i in range(5)]  # 40 of 50 shingles shared: 0.8
        _, keys = P._hashes([(0, 0, ws), (0, 1, other)])
        hit += bool(np.any(keys[0] == keys[1]))
    assert hit >= 0.95 * 400


def test_drop_repeated(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen."
    rows = [(1, "Start here. " + passage + " End.", "a", 5), (2, "Other words before it all come first now. " + passage, "b", 6),
            (3, passage, "c", 7), (4, None, "d", 8), (5, "", "e", 9), (None, "unique line\nof text", "f", 1), (4, "x", "g", 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, words string, paragraph int").repartition(3)
    got = {(r.words): (r.doc_id, r.text, r.paragraph) for r in P.drop_repeated(df).collect()}
    assert got == {"a": (1, rows[0][1], 5), "b": (2, "Other words before it all come first now. ", 6), "d": (4, None, 8),
                   "e": (5, "", 9), "f": (None, "unique line\nof text", 1), "g": (4, "x", 2)}
    assert P.drop_repeated(df).columns == df.columns


def test_repeated_rows_and_empty(spark):
    line = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(7, line)] * 3 + [(None, line)] * 2 + [(9, line)], "doc_id bigint, text string")
    got = [(r.doc_id, r.paragraph, r.removed) for r in P.repeated_paragraphs(df).collect()]
    assert sorted(got, key=repr) == sorted([(None, 0, False), (None, 0, True), *[(7, 0, True)] * 3, (9, 0, True)], key=repr)
    left = P.drop_repeated(df.withColumn("row", F.lit(1)))  # one row stays, of rows without id too
    assert [r.doc_id for r in left.collect()] == [None] and left.columns == ["doc_id", "text", "row"]
    assert P.repeated_paragraphs(df.where("false")).count() == 0


def removed_words(spark, docs):
    """Words left of each text, by doc_id."""
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    left = {r.doc_id: len(r.text.split()) for r in P.drop_repeated(df).collect()}
    return {d: len(t.split()) - left.get(d, 0) for d, t in docs}


def test_passages_planted_inside_sentences(spark):
    rng = random.Random(11)
    words = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    docs = []
    for k in range(40):
        passage = words(60)  # no mark, no line break
        docs += [(2 * k, " ".join(words(rng.randrange(5, 40)) + passage + words(rng.randrange(5, 40)))),
                 (2 * k + 1, " ".join(words(rng.randrange(5, 40)) + passage + words(rng.randrange(5, 40))))]
    gone = removed_words(spark, docs)
    found = [gone[2 * k + 1] for k in range(40)]
    assert not any(gone[2 * k] for k in range(40))
    assert all(n <= 60 for n in found) and sum(n > 0 for n in found) >= 38 and sum(found) > 0.4 * 40 * 60


def test_passages_of_short_lines_and_sentences(spark):
    rng = random.Random(12)
    line = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    docs = []
    for k in range(40):
        end = rng.choice(["\n", ". "])
        lines = lambda n: [line(rng.randrange(2, 8)) for _ in range(n)]  # noqa: E731, B023
        passage = lines(20)
        docs += [(2 * k + i, end.join(lines(rng.randrange(1, 9)) + passage + lines(rng.randrange(1, 9)))) for i in (0, 1)]
    gone = removed_words(spark, docs)
    assert not any(gone[2 * k] for k in range(40)) and all(gone[2 * k + 1] > 30 for k in range(40))


def test_every_word_is_compared():
    for _, t in corpus():
        t = (t or "").encode().lower()
        units = P.paragraphs(t)
        assert all(len(ws) >= P.MIN_WORDS for _, ws in units[:-1])
        compared = {k: ws for _, k, ws in P._long_paragraphs([t])}
        if len(t.split()) >= P.MIN_WORDS:
            assert all(compared[k][-len(ws):] == ws and len(compared[k]) >= P.MIN_WORDS for k, (_, ws) in enumerate(units))


def test_short_runs_stay(spark):
    rng = random.Random(3)
    words = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    short, long = words(12) + ".", words(16) + "."
    docs = [(k, f"{words(30)}. {short} {words(30)}. {long if k > 1 else words(9) + '.'} {words(20)}") for k in range(4)]
    got = {(r.doc_id, r.n_words) for r in P.repeated_paragraphs(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert {d for d, _ in got} == {2, 3}


def test_a_band_of_unlike_members_takes_bounded_time(spark):
    """50,000 paragraphs with a third of their words in common share one band; only planted pairs are alike."""
    rng = random.Random(6)
    common = [f"c{k}".encode() for k in range(7)]
    rows = [(k, b" ".join(common + [b"%d" % rng.randrange(10**9) for _ in range(14)])) for k in range(50_000)]
    for k in range(0, 2000, 20):
        ws = rows[k][1].split()
        rows[k + 1] = (k + 1, b" ".join([*ws[:-1], b"z"]))
    texts = spark.createDataFrame(rows, "content bigint, words binary").repartition(8).cache()
    lists = texts.select(F.lit(1).cast("bigint").alias("band"), "content", F.lit(len(rows)).cast("bigint").alias("members"))
    start = time.time()
    got = {tuple(sorted(r)) for r in P._links(lists, texts, 0.8).collect()}
    assert time.time() - start < 120
    want = {(k, k + 1) for k in range(0, 2000, 20)}
    assert got <= want and len(got) >= 0.97 * len(want)
