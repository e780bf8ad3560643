"""Token-id output: raw id payloads in shards and a minimal perfect hash index over them.

Layout of a store folder::

    payload-<shard>-<attempt>.ids   ids of its documents one after another, little-endian
                                    uint16 or uint32, documents in ascending doc_id order
    index-<part>-<attempt>.npz      minimal perfect hash over the keys of the part, and per slot a
                                    stored fingerprint, the shard, the offset and the token count
    written/, shards/, parts/       Parquet: the documents written (doc_id, k, shard, offset, count),
                                    the shards' files and token counts, the parts' index files

A record's key is (doc_id, j, k): k counts the repeats of a doc_id within a
shard, j the shards that a repeated doc_id runs over; both are 0 for a doc_id
that occurs once.  A key's part and its slot there come from its 128-bit hash
alone, so an access costs the same however many keys there are.  Files are
written under an attempt's own name and counted only if the Parquet tables
list them, so a lost executor or a retried task leaves no half-written result.
"""

from __future__ import annotations

import io
import json
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import text as tx
from .storage import stage_path, staged

#: Bits per remaining key at each level of the hash.
GAMMA = 2.0


def _mix(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    """A fresh 64-bit value of a 128-bit key for each level."""
    x = h1 ^ (h2 * np.uint64(2 * level + 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Levels of bit arrays: a key's slot is the rank of the first set bit it meets."""

    def __init__(self, words, ranks, sizes):
        self.words, self.ranks, self.sizes = words, ranks, sizes  # 64 bits each; set bits before each word; bits a level

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        """From distinct 128-bit keys: those alone on a position of a level keep it, the others go on."""
        words, sizes, level = [], [], 0
        while len(h1):
            if level == 1:  # equal keys are never alone
                order = np.lexsort((h2, h1))
                if np.any((np.diff(h1[order]) == 0) & (np.diff(h2[order]) == 0)):
                    raise ValueError("equal keys")
            m = 64 * math.ceil(max(64, GAMMA * len(h1)) / 64)
            at = (_mix(h1, h2, level) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m)[at] == 1
            bits = np.zeros(m, np.uint8)
            bits[at[alone]] = 1
            words.append(np.packbits(bits, bitorder="little").view("<u8"))
            sizes.append(m)
            h1, h2, level = h1[~alone], h2[~alone], level + 1
        words = np.concatenate(words) if words else np.zeros(0, "<u8")
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        return cls(words, ranks, np.array(sizes, np.int64))

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has it."""
        out, todo, base = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
        for level, m in enumerate(self.sizes.tolist()):
            at = (_mix(h1[todo], h2[todo], level) % np.uint64(m)).astype(np.int64)
            word, bit = base + at // 64, (at % 64).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[todo[hit]] = self.ranks[word[hit]] + np.bitwise_count(below)
            todo, base = todo[~hit], base + m // 64
        return out


@dataclass
class Store:
    """A written store: its folder, and the tables that say what counts."""
    path: str
    dtype: str
    parts: int
    records: DataFrame
    shards: DataFrame
    index: DataFrame


def _open(path: str):
    return pafs.FileSystem.from_uri(path)


def _key_hashes(*key: Column) -> list[Column]:
    return [F.xxhash64(*key).alias("h1"), F.xxhash64(F.lit("second"), *key).alias("h2")]


def _attempt_name(kind: str, n: int, ending: str) -> str:
    return f"{kind}-{n:06d}-{TaskContext.get().taskAttemptId()}.{ending}"


def _write_payload(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, dtype: str) -> DataFrame:
    """Range-partition by doc_id and write a payload file per partition; returns a row per document."""
    file = docs.sparkSession.sparkContext.broadcast(tx.read_file(tokenizer_path))
    # Ties get a fixed order of their own, so a repeated doc_id may run over several shards.
    docs = docs.withColumn("tie", F.monotonically_increasing_id())
    ordered = docs.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def write(batches):
        chunks, shard = tx.word_encoder(file.value), TaskContext.get().partitionId()
        fs, folder = _open(path)
        name, out = _attempt_name("payload", shard, "ids"), None
        record = offset = repeat = 0
        last = object()
        for b in batches:
            if out is None:
                fs.create_dir(folder, recursive=True)
                out = fs.open_output_stream(f"{folder}/{name}")
            ks, offsets, counts = [], [], []
            for key, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                ids = np.append(np.frombuffer(tx.encode_ids(chunks, t), "<u4"), np.uint32(end_id))
                out.write(ids.astype(dtype).tobytes())
                repeat, last = (repeat + 1 if key == last and record else 0), key
                ks.append(repeat), offsets.append(offset), counts.append(len(ids))
                record, offset = record + 1, offset + len(ids)
            n = len(ks)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ks, pa.int64()), pa.array([shard] * n, pa.int32()), pa.array([name] * n),
                 pa.array(offsets, pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "k", "shard", "file", "offset", "n_tokens"])
        if out is not None:
            out.close()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return ordered.mapInArrow(write, f"doc_id {kind}, k bigint, shard int, file string, offset bigint, n_tokens bigint")


def _write_index(records: DataFrame, path: str, parts: int) -> DataFrame:
    """Build one perfect hash file per part of the key hash; returns (part, index_file, n_keys)."""
    keyed = records.select(*_key_hashes("doc_id", "j", "k"), "shard", "offset", "n_tokens").withColumn(
        "part", F.pmod("h1", F.lit(parts)).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        h1, h2 = (table[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
        found = PerfectHash.build(h1, h2)
        slot, n = found.slots(h1, h2), len(h1)
        arrays = {"fingerprint": (h2 >> np.uint64(32)).astype("<u4")} | {
            c: table[c].to_numpy() for c in ("shard", "offset", "n_tokens")}
        for c, v in arrays.items():
            arrays[c] = np.empty(n, v.dtype)
            arrays[c][slot] = v
        part = table["part"][0].as_py()
        fs, folder = _open(path)
        name, held = _attempt_name("index", part, "npz"), io.BytesIO()
        np.savez(held, words=found.words, ranks=found.ranks, sizes=found.sizes, **arrays)
        with fs.open_output_stream(f"{folder}/{name}") as out:
            out.write(held.getbuffer())
        return pa.table({"part": pa.array([part], pa.int32()), "index_file": [name], "n_keys": pa.array([n], pa.int64())})

    return keyed.groupBy("part").applyInArrow(build, "part int, index_file string, n_keys bigint")


def _starts(shards: DataFrame) -> DataFrame:
    """Tokens before each shard; a row per shard, so one task orders them."""
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("shard", "file", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("start"))


def _records(written: DataFrame, shards: DataFrame) -> DataFrame:
    """The written documents with j: how many shards earlier their doc_id began (it then ended each one's range)."""
    first = shards.groupBy("last_id").agg(F.min("shard").alias("first_shard"))  # null: a shard of null ids only
    return written.join(F.broadcast(first), F.col("doc_id").eqNullSafe(F.col("last_id")), "left").select(
        "doc_id", (F.col("shard") - F.coalesce("first_shard", "shard")).cast("bigint").alias("j"),
        "k", "shard", "offset", "n_tokens")


def write_store(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> Store:
    """Encode every whole text, append ``end_id`` and write payload shards and index.

    Ids take two bytes where the vocabulary and ``end_id`` allow, else four.
    Null or empty text: the end id alone.  A null doc_id comes first and is a
    key like any other; repeated rows are records of their own.  An empty
    table writes no file.  Other columns are ignored.
    """
    spark = docs.sparkSession
    path = path or stage_path(spark, "tokens")
    spec = json.loads(tx.read_file(tokenizer_path))
    top = max([end_id, *spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))])
    dtype = "<u2" if top < 1 << 16 else "<u4"
    written = staged(_write_payload(tx.id_text(docs, id_col, text_col), path, tokenizer_path, end_id, dtype),
                     "records", f"{path}/written")
    # One row per shard from here on: bounded by the number of partitions.
    shards = staged(written.groupBy("shard", "file").agg(
        F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_records"), F.max("doc_id").alias("last_id")),
        "shards", f"{path}/shards")
    records = _records(written, shards)
    n = shards.agg(F.sum("n_records")).first()[0] or 0
    parts = max(1, math.isqrt(n) // 4)  # parts and keys a part both grow slowly
    index = staged(_write_index(records, path, parts).withColumns(
        {"of_parts": F.lit(parts), "dtype": F.lit(dtype)}), "parts", f"{path}/parts")
    return Store(path, dtype, parts, records, _starts(shards), index)


def lookup(store: Store, keys: DataFrame) -> DataFrame:
    """(doc_id, j, k, shard, offset, n_tokens) of each key (doc_id, j, k) the index holds; others give no row."""
    path = store.path
    hashed = keys.select("doc_id", "j", "k", *_key_hashes("doc_id", "j", "k")).withColumn(
        "part", F.pmod("h1", F.lit(store.parts)).cast("int"))
    asked = hashed.join(F.broadcast(store.index.select("part", "index_file")), "part")  # a row per index file

    def find(table: pa.Table) -> pa.Table:
        fs, folder = _open(path)
        with fs.open_input_file(f"{folder}/{table['index_file'][0].as_py()}") as f:
            at = np.load(io.BytesIO(f.read()))
            h1, h2 = (table[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
            slot = PerfectHash(at["words"], at["ranks"], at["sizes"]).slots(h1, h2)
            held = (slot >= 0) & (at["fingerprint"][slot] == (h2 >> np.uint64(32)).astype("<u4"))
            slot, mask = slot[held], pa.array(held)
            return pa.table([*(table[c].filter(mask) for c in ("doc_id", "j", "k")),
                             *(pa.array(at[c][slot]) for c in ("shard", "offset", "n_tokens"))],
                            ["doc_id", "j", "k", "shard", "offset", "n_tokens"])

    kind = keys.schema["doc_id"].dataType.simpleString()
    return asked.groupBy("part").applyInArrow(
        find, f"doc_id {kind}, j bigint, k bigint, shard int, offset bigint, n_tokens bigint")


def read_documents(store: Store, found: DataFrame) -> DataFrame:
    """(doc_id, j, k, start, n_tokens, ids) read from the payload at what ``lookup`` found; ids: uint32 bytes."""
    path, dtype = store.path, store.dtype
    placed = found.join(F.broadcast(store.shards.select("shard", "file", F.col("start").alias("shard_start"))), "shard")

    def read(batches):
        fs, folder = _open(path)
        width, opened, source = np.dtype(dtype).itemsize, None, None
        for b in batches:
            ids = []
            for name, offset, n in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "n_tokens"))):
                if name != opened:
                    if source is not None:
                        source.close()
                    opened, source = name, fs.open_input_file(f"{folder}/{name}")
                raw = source.read_at(n * width, offset * width)
                ids.append(np.frombuffer(raw, dtype).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "j", "k", "start", "n_tokens")), pa.array(ids, pa.binary())],
                ["doc_id", "j", "k", "start", "n_tokens", "ids"])

    kind = found.schema["doc_id"].dataType.simpleString()
    rows = placed.withColumn("start", F.col("shard_start") + F.col("offset")).repartition("file").sortWithinPartitions(
        "file", "offset")
    return rows.mapInArrow(read, f"doc_id {kind}, j bigint, k bigint, start bigint, n_tokens bigint, ids binary")


def crc32s(read: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of documents read back."""
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def open_store(spark: SparkSession, path: str) -> Store:
    """A store written earlier, from its folder."""
    index = spark.read.parquet(f"{path}/parts")
    head = index.first()
    written, shards = spark.read.parquet(f"{path}/written"), spark.read.parquet(f"{path}/shards")
    return Store(path, head.dtype if head else "<u4", head.of_parts if head else 1, _records(written, shards),
                 _starts(shards), index)
