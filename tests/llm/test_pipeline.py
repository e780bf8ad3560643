"""The pipeline stage by stage against brute force on a small table."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from encore.llm import bm25, importance
from encore.llm import paragraphs as P
from test_bm25 import brute as brute_items
from test_paragraphs import brute as brute_paragraphs
from test_simhash import plain_components, plain_fingerprint
from test_tokens import check_packing

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        if name != "best-fit packing":
            assert after.columns == COLUMNS
        after = spark.createDataFrame(after.collect(), after.schema)
        out.append((docs, after))
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_quality(spark, stages):
    docs, after = stages[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 AND toxic = 0").select("doc_id")
    want = {r.doc_id for r in importance.quality(docs, labels).where("kept").collect()}
    assert set(texts(after)) == want and 0 < len(want) < docs.count()


def test_simhash(stages):
    docs, after = (texts(x) for x in stages[1])
    ids = sorted(docs)
    roots = plain_components(ids, [plain_fingerprint(docs[d]) for d in ids], 3)
    assert after == {d: docs[d] for d in set(roots)} and len(after) < len(docs)


def test_paragraphs(stages):
    docs, after = (texts(x) for x in stages[2])
    gone = {}
    for (d, k), _, removed in brute_paragraphs(docs.items()):
        if removed:
            gone.setdefault(d, set()).add(k)
    want = {d: P.without_paragraphs(t.encode(), gone.get(d, set())).decode() for d, t in docs.items()}
    assert after == {d: t for d, t in want.items() if t.split() or d not in gone} and gone


def test_decontamination(spark, stages):
    docs, after = (texts(x) for x in stages[3])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {d for d, _ in brute_items(items, docs.items())}
    planted = {d for d, t in docs.items() if any(i in t for _, i in items)}
    assert set(after) == set(docs) - hit and planted and planted <= hit


def test_packing(stages):
    docs, rows = texts(stages[4][0]), stages[4][1].collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for d, t in docs.items():
        ids = tok.encode(t, add_special_tokens=False).ids + [0]
        want += [(d, k, a, len(ids[a:a + 2048]), zlib.crc32(np.array(ids[a:a + 2048], "<u4").tobytes()))
                 for k, a in enumerate(range(0, len(ids), 2048))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    assert check_packing(rows, 2048) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_run_equals_its_stages(spark, stages):
    key = lambda r: tuple(r[:5])
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, stages[4][1].collect()))


def test_stages_take_odd_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, filled int, words string"
    rows = [(None, None, None, None, None, 1, "x"), (1, "", "en", "s", 0, 1, "x"), (1, None, "en", "s", 0, 1, "x"),
            *[(5, "w1 w2. " * 40, "en", "s", 9, 2, "y")] * 2, (7, " ".join(f"word{i}" for i in range(30000)), "de", None, 1, 3, "z")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, SF)
            assert name == "best-fit packing" or after.columns == docs.columns
            assert after.count() <= 100 * len(data)


def test_items_are_words():
    assert bm25.words(b"The &&&end.%%%") == [b"the", b"end"]
