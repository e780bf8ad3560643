"""Block-max WAND against full scoring; planted test items against brute force."""

import random

import numpy as np

from encore.llm import bm25


def plain(index, terms, threshold):
    score = {}
    for t in terms:
        for p in index.postings[index.start[t]:index.start[t + 1]]:
            for i, w in p:
                score[i] = score.get(i, 0) + w
    return {i: s for i, s in score.items() if s >= threshold}


def test_wand_returns_all_above_threshold():
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    index = bm25.Index([" ".join(rng.choices(vocab, weights, k=rng.randrange(1, 40))).encode() for _ in range(700)])
    assert index.blocks > 50
    for threshold in (0.05, 0.2, 0.5, 0.9):
        n = 0
        for _ in range(100):
            terms = rng.sample(range(len(index.term)), rng.randrange(1, 40))
            bound = index.bounds(np.zeros(len(terms), np.int64), np.array(terms), 1)[0]
            got, want = {}, plain(index, terms, threshold)
            for block in range(index.blocks):
                some = index.retrieve(terms, block, threshold)
                assert not some or bound[block] >= threshold - 1e-9  # a block passed over holds nothing
                got |= some
            near = {i for i in set(got) ^ set(want) if abs(want.get(i, got.get(i)) - threshold) > 1e-9}
            assert not near and all(abs(got[i] - want[i]) < 1e-9 for i in set(got) & set(want))
            n += len(want)
        assert n


def items_and_docs():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    items = [(i, " ".join(sentence(rng.randrange(4, 15)) for _ in range(rng.randrange(1, 4)))) for i in range(40)]
    items += [(100, None), (101, ""), (None, "Only one. Null id here so it is kept apart from all others.")]
    docs = [(1000, None), (1001, ""), (1002, "short")]
    for d in range(120):
        filler = [sentence(rng.randrange(3, 20)) for _ in range(rng.randrange(30))]
        kind, (i, t) = rng.choice(["none", "whole", "upper", "question", "answer", "marked"]), rng.choice(items[:40])
        parts = t.split(". ")
        t = {"none": "", "whole": t, "upper": t.upper(), "question": ". ".join(parts[:-1]), "answer": parts[-1],
             "marked": t.replace(" ", "%%% ")}[kind]
        filler.insert(rng.randrange(len(filler) + 1), t)
        docs.append((d, rng.choice([" ", "\n"]).join(filler)))
    return items, docs + [(None, items[3][1]), (7, items[3][1]), (7, items[3][1])]


def brute(items, docs):
    out = []
    for d, t in docs:
        ws = bm25.words((t or "").encode())
        for i, it in items:
            own = bm25.words((it or "").encode())
            if not own:
                continue
            (q, a), = bm25.Index([it.encode()]).parts
            grams = bm25.shingles(ws)
            if len(q & grams) >= 0.8 * len(q) and len(a & grams) >= 0.8 * len(a):
                out.append((d, i))
    return out


def test_contamination_equals_brute_force(spark, monkeypatch):
    items, docs = items_and_docs()
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id bigint, text string, item_id string, at int").repartition(3)
    it = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, doc_id string")
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0)
    want = sorted(brute(items, docs), key=key)
    got = bm25.contamination(df, it).collect()
    assert len(want) > 30 and sorted([(r.doc_id, r.item_id) for r in got], key=key) == want
    assert all(0.6 <= r.score <= 1 + 1e-9 and min(r.question_overlap, r.answer_overlap) >= 0.8 for r in got)
    monkeypatch.setattr(bm25, "INDEX_ITEMS", 7)
    assert sorted([(r.doc_id, r.item_id) for r in bm25.contamination(df, it).collect()], key=key) == want
    left = bm25.decontaminated(df, it)
    assert left.columns == df.columns
    hit = {d for d, _ in want}
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, _ in docs if d not in hit)


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    assert bm25.contamination(docs, items).count() == 0 and bm25.decontaminated(docs, items).count() == 1
    full = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert bm25.contamination(docs.where("false"), full).count() == 0


def test_short_questions_answers_and_items_are_found(spark):
    texts = ["What is the name of the river near our town? Er.", "Who went there? The old man from the far green valley did.",
             "Why not? Because.", "Only four words here.", "Er.", "Which of the two roads leads over the hill now? Left. One."]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    filler = "some filler words stand around the item on both sides of it in every text "
    docs = [(k, filler * 3 + t.upper() + " " + filler * 3) for k, t in enumerate(texts)]
    docs += [(10, filler + texts[0][:-4] + filler), (11, filler + "left one " + filler + texts[5][:-11] + filler),
             (12, filler + texts[0][:-3] + "Answer: " + texts[0][-3:] + filler), (13, "not because why " + filler)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    folded = {d: b" ".join([b"", *bm25.words(t.encode()), b""]) for d, t in docs}
    whole = {(d, i) for d, t in folded.items() for i, it in enumerate(texts)
             if b" ".join([b"", *bm25.words(it.encode()), b""]) in t}
    got = {(r.doc_id, r.item_id) for r in bm25.contamination(df, items).collect()}
    assert {(k, k) for k in range(6)} <= whole and got == whole | {(12, 0)}
    assert {r.doc_id for r in bm25.decontaminated(df, items).collect()} == {10, 11, 13}
