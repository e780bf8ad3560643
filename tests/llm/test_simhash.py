"""SimHash fingerprints, links and components against brute force."""

import itertools
import random
import re

import numpy as np
import xxhash

from encore.llm import components, simhash


def plain_fingerprint(text):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not ws:
        return 0
    grams = [b" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or [b" ".join(ws)]
    h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def plain_components(ids, fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= bits:
            root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(fps))]


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choices(["Ab", "cd", "é", "fg", "X y", "zz\x1cq"], k=rng.randrange(1, 400))) for _ in range(25)]
    texts = [None, "", " \t\n", "one", "two words"]
    for t in base:
        ws = t.split(" ")
        texts += [t, t.upper().replace("É", "é"), t + " tail", " ".join(ws[:-1])]
        texts += [" ".join(w if rng.random() > p else "new" for w in ws) for p in (.005, .01, .02, .1)]
    rows = [(i if i % 17 else None, t, "clash", 1) for i, t in enumerate(texts)] + [(3, "one", "clash", 2)] * 3
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, fp string, component_id int").repartition(4)
    got = simhash.near_duplicates(df)
    fps = [plain_fingerprint(t) for _, t, _, _ in rows]
    want = plain_components([d for d, *_ in rows], fps, 3)
    assert len(set(want)) < len(set(fps))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(
        ((d, f"{f:016x}", c) for (d, *_), f, c in zip(rows, fps, want)), key=key)


def test_long_text_in_blocks(monkeypatch):
    t = " ".join(random.Random(1).choices(["a", "b", "c", "d"], k=500))
    whole = simhash.fingerprint(t.encode()) % (1 << 64)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(t.encode()) % (1 << 64) == whole == plain_fingerprint(t)


def test_links_join_what_is_near(spark):
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(100)}
    for f in list(fps)[:60]:  # chains and balls around some
        for _ in range(8):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5)))
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), 3)
    near = {(a, b) for a, b in edges.collect()}
    assert all(bin((a ^ b) % (1 << 64)).count("1") <= 3 for a, b in near)
    roots = {r.node: r.root for r in components.components(edges).collect()}
    want = plain_components(signed, fps, 3)
    assert [roots.get(f, f) for f in signed] == want


def test_large_list_takes_bit_changes():
    rng = np.random.default_rng(2)
    low = np.unique(rng.integers(0, 1 << 16, 9000, np.uint64))  # all differ in two low bytes
    far = np.unique(rng.integers(0, 1 << 24, 3000, np.uint64))
    fps = np.unique(np.concatenate([low, far]))
    got = simhash.forest(fps, (0, 1, 2), 3)
    assert len(fps) > 4097 and len(got) == len(set(map(frozenset, got))) <= len(fps) - 1
    assert all(bin(a ^ b).count("1") <= 3 for a, b in got)
    index = {int(f): k for k, f in enumerate(fps)}
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for a, b in got:
        assert find(index[a]) != find(index[b])
        root[find(index[a])] = find(index[b])
    top = np.array([find(i) for i in range(len(fps))])
    for k in range(0, len(fps), 37):
        near = np.bitwise_count(fps ^ fps[k]) <= 3
        assert len(set(top[near])) == 1


def test_components_of_path_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(50)] + [(7, 7), (3, 2), (2000, 2000)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_one_of_each_by_row(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(40)) for c in "ab")
    rows = [(3, b, "x"), (5, a, "x"), (5, b, "y"), (7, a, "z"), (None, a, "n"), (None, a, "m"), (None, "only here", "k"),
            (None, "only here", "l"), (9, None, "e"), (8, "", "f")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, root string")
    got = simhash.one_of_each(df)
    assert got.columns == df.columns
    kept = sorted([tuple(r) for r in got.collect()], key=repr)
    assert [r[:2] for r in kept if r[0] is not None] == [(3, b), (5, a), (8, "")]
    assert [r[:2] for r in kept if r[0] is None] == [(None, "only here")]
    assert simhash.one_of_each(df.limit(0)).count() == 0
