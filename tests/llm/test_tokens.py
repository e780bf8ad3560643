"""Token counts, token store and packing against the tokenizer library and brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, pre_tokenizers

from encore.llm import text as tx
from encore.llm import bpe_count, packing, text, token_store

SCHEMA = "doc_id bigint, text string, n_tokens string, piece string"
ODD = ["", " ", "\n\n", "a", "it's  we'll\t x y", "<|endoftext|>a <|endoftext|>", "<|ENDOFTEXT|>", "é̈ ß Σς", "x" * 5000,
       "123 4567!? ...\r\n\r\n  z", "\x1c\x1d a\x85b c 　", "日本語 テキスト 🙂🙂 ", "<|startoftext|><|startoftext", "'S 'd'LL"]


def odd_texts(n=60, seed=7):
    rng = random.Random(seed)
    alphabet = list("abth e  \n\t'.,!0é𝒳") + ["the", "'re", "  ", "\x1c", "<|endoftext|>", "ﬁ", "İ", "́"]
    return ODD + ["".join(rng.choices(alphabet, k=rng.randrange(80))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], SCHEMA)


def test_token_counts_equal_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = odd_texts() + [None]
    tok = Tokenizer.from_file(path)
    got = {r.doc_id: r for r in bpe_count.token_counts(frame(spark, texts), path, limit=5).collect()}
    for i, t in enumerate(texts):
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 5), repr(t)


def test_token_counts_empty_and_repeated(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert bpe_count.token_counts(frame(spark, []), path).count() == 0
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None), (3, None)], "doc_id bigint, text string")
    assert sorted(r.n_tokens for r in bpe_count.token_counts(df, path).collect()) == [0, 0, 2, 2]


WORDS = public_tokenizers.path("word_bpe_49k.json")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_chunked_ids_equal_whole_text():
    tok = Tokenizer.from_file(WORDS)
    chunks = text.word_encoder(text.read_file(WORDS))
    for t in odd_texts(400, 3):
        ids = np.frombuffer(text.encode_ids(chunks, t.encode()), "<u4").tolist()
        assert ids == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_token_store_round_trip(spark):
    tok = Tokenizer.from_file(WORDS)
    texts = odd_texts() + [None]
    df = frame(spark, texts).repartition(5)
    store = token_store.write_store(df, WORDS, 2)
    got = {r.doc_id: r for r in token_store.crc32s(
        token_store.read_documents(store, token_store.lookup(store, store.records))).collect()}
    start = 0
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    again = token_store.open_store(spark, store.path)
    keys = spark.createDataFrame([(3, 0, 0), (10**9, 0, 0), (3, 0, 1), (3, 1, 0)], "doc_id bigint, j bigint, k bigint")
    (row,) = token_store.read_documents(again, token_store.lookup(again, keys)).collect()
    assert row.doc_id == 3 and np.frombuffer(row.ids, "<u4").tolist() == tok.encode(texts[3]).ids + [2]


def test_token_store_repeated_null_and_empty(spark):
    rows = [(None, "a"), (None, None), *[(7, "same text")] * 40, (8, ""), (9, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    store = token_store.write_store(df, WORDS, 2)
    out = token_store.read_documents(store, token_store.lookup(store, store.records)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == sorted((i is None, i or 0) for i, _ in rows)
    spans = sorted((r.start, r.n_tokens) for r in out)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    assert [r.doc_id for r in sorted(out, key=lambda r: r.start)] == [None] * 2 + [7] * 40 + [8, 9]
    assert len({(r.doc_id, r.j, r.k) for r in out}) == len(rows)
    none = token_store.write_store(df.where("false"), WORDS, 2)
    assert token_store.lookup(none, none.records).count() == 0


def test_token_store_null_ids_over_many_shards(spark):
    rows = [(None, f"null {i}") for i in range(60)] + [(i, f"text {i}") for i in range(40)]
    forced = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in forced}
    try:
        for k, v in forced.items():
            spark.conf.set(k, v)
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
        store = token_store.write_store(df, WORDS, 2)
        keys = store.records.collect()
        assert len({r.shard for r in keys if r.doc_id is None}) > 2
        assert len({(r.doc_id, r.j, r.k) for r in keys}) == len(rows)
        out = token_store.read_documents(store, token_store.lookup(store, store.records)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    tok = Tokenizer.from_file(WORDS)
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in out) == sorted(tok.encode(t).ids + [2] for _, t in rows)
    spans = sorted((r.start, r.n_tokens) for r in out)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0


def test_perfect_hash_refuses_equal_keys():
    h = np.arange(10, dtype=np.uint64)
    with pytest.raises(ValueError):
        token_store.PerfectHash.build(np.append(h, h[3]), np.append(h, h[3]))


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    h1, h2 = (rng.integers(0, 2**64, 5000, np.uint64) for _ in range(2))
    h1[:200] = h1[0]  # only the second halves differ
    ph = token_store.PerfectHash.build(h1, h2)
    assert sorted(ph.slots(h1, h2).tolist()) == list(range(5000))


def check_packing(rows, cap):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for seq in by.values():
        at = 0
        for offset, n in sorted(seq):
            assert offset == at
            at += n
        assert at <= cap
    return len(by)


def test_packing_pieces_and_offsets(spark):
    tok = Tokenizer.from_file(WORDS)
    texts = odd_texts() + [None, "word " * 400]
    rows = packing.packed_documents(frame(spark, texts), WORDS, end_id=0, max_len=64).collect()
    n_seq = check_packing(rows, 64)
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [(r.start, r.length, r.ids_crc32) for r in own] == [
            (a, len(ids[a:a + 64]), crc(ids[a:a + 64])) for a in range(0, len(ids), 64)]
    assert n_seq <= -(-sum(r.length for r in rows) // 64) + 1
    assert packing.packed_documents(frame(spark, []), WORDS).count() == 0


@given(st.lists(st.integers(1, 20), max_size=40))
@settings(max_examples=200, deadline=None)
def test_local_search_keeps_items_and_never_adds_bins(lengths):
    start = packing.best_fit(lengths, 20)
    bins = packing.local_search([list(b) for b in start], lengths, 20)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert len(bins) <= len(start) and all(0 < sum(lengths[i] for i in b) <= 20 for b in bins)


def test_local_search_empties_a_bin():
    # 6+6, 5+5, 4+4 of 15 each and 9: total 39 fits three bins of 15 only after exchanges.
    lengths = [6, 6, 5, 5, 4, 4, 9]
    bins = packing.local_search([[0, 1], [2, 3], [4, 5], [6]], lengths, 15)
    assert len(bins) == 3


def test_packing_spreads_over_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 50)
    rng = random.Random(5)
    lens = [rng.randrange(1, 1500) for _ in range(1000)]
    rows = packing.pack(spark.createDataFrame([(7, n) for n in lens], "doc_id bigint, length bigint")).collect()
    assert sorted(r.length for r in rows) == sorted(lens)
    assert check_packing(rows, 2048) <= 1.02 * sum(lens) / 2048 + 1


def test_recent_keeps_what_is_asked_for():
    made = []
    keep = tx.Recent(lambda k: made.append(k) or (k,), 20)
    for k in range(200):
        assert keep[k] == (k,) and keep["often"] == ("often",)
        assert len(keep) + len(keep.older) <= 21
    assert made.count("often") == 1 and len(made) == 201


def test_words_of_letters_skip_the_whole_way():
    tok = Tokenizer.from_file(WORDS)
    letters = tx._letters(tok)
    rng = random.Random(11)
    words = ["".join(rng.choices(tx._LETTERS, k=rng.randrange(1, 12))) + "".join(rng.choices("!.,<|>#_-`~", k=rng.randrange(4)))
             for _ in range(3000)] + ["x'", "'s", "o's!", "a\u0301.", "e\u0338", "×a", "a÷", "ÀÉ!!", "ß", "ŉ", "a1", "a<|endoftext|>", "a<|"]
    chunks = tx.word_encoder(tx.read_file(WORDS))
    for w in words:
        ids = tok.encode(w, add_special_tokens=False).ids
        assert np.frombuffer(chunks[w.encode()], "<u4").tolist() == ids, repr(w)
        if all(c in tx._LETTERS for c in w):
            assert [t.id for t in tok.model.tokenize(w.translate(letters))] == ids
    assert len(letters) == len(tx._LETTERS)
    other = Tokenizer.from_file(WORDS)
    other.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("e", "isolated"), other.pre_tokenizer])
    assert tx._letters(other) == {}
