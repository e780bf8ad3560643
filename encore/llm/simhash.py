"""SimHash near-duplicates through an inverted index of fingerprint bytes.

Two 64-bit fingerprints within d differing bits share at least 8 - d of their
eight byte positions.  The index lists every distinct fingerprint under each
choice of 8 - d positions and the bytes there, so a pair stands in a common
list exactly when its tally of shared positional bytes reaches that minimum
(in more lists the higher the tally); the bits of the pairs of a list are then
compared.  A list holds fingerprints that differ in d bytes only, and of it
just the links of a spanning forest leave, so copies never become all pairs.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .components import components
from .storage import numbered, staged

#: Shingles whose bits are tallied at a time.
BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles, as a signed integer; 0 without words."""
    ws = text.lower().split()
    if not ws:
        return 0
    n = max(1, len(ws) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        part = ws[at:at + BLOCK + shingle - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(shingle)))) if len(ws) >= shingle else [b" ".join(ws)]
        hashes = np.array([xxhash.xxh64_intdigest(g, 42) for g in grams], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 keep: str | None = None) -> DataFrame:
    """(doc_id, fp) of every whole text, one row per input row, and the column ``keep``, a string, if asked for."""
    extra = [keep] if keep else []

    def run(batches):
        tx.forget()
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64()), *(b.column(c) for c in extra)],
                                             ["doc_id", "fp", *extra])

    src = docs.select(tx.col(id_col).alias("doc_id"), F.coalesce(tx.col(text_col), F.lit("")).alias("text"), *extra)
    kept = "".join(f", {c} string" for c in extra)
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, fp bigint{kept}")


def _near_masks(byte_places: tuple[int, ...], max_bits: int) -> np.ndarray:
    """All non-zero changes of up to ``max_bits`` bits within the given bytes."""
    bits = [np.uint64(1) << np.uint64(8 * p + k) for p in byte_places for k in range(8)]
    return np.array([np.bitwise_or.reduce(c) for n in range(1, max_bits + 1) for c in itertools.combinations(bits, n)],
                    np.uint64)


def forest(fps: np.ndarray, free: tuple[int, ...], max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of distinct fingerprints that differ in the ``free`` bytes only.

    A node looks at the nodes not yet reached, or, where those are more, at
    each change of up to ``max_bits`` bits: linear in the list's length.
    """
    links, todo = [], fps
    while len(todo):
        stack, todo = [todo[0]], todo[1:]
        if len(todo) > 4096 and max_bits <= 3:
            masks, rest = _near_masks(free, max_bits), set(todo.tolist())
            while True:
                while stack and rest:
                    u = stack.pop()
                    near = [v for v in (masks ^ u).tolist() if v in rest]
                    rest.difference_update(near)
                    links += [(int(u), v) for v in near]
                    stack += [np.uint64(v) for v in near]
                if not rest:
                    return links
                stack = [np.uint64(rest.pop())]
        while stack and len(todo):
            u = stack.pop()
            near = np.bitwise_count(todo ^ u) <= max_bits
            links += [(int(u), v) for v in todo[near].tolist()]
            stack += list(todo[near])
            todo = todo[~near]
    return links


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that join all within ``max_bits`` bits into components."""
    choices = list(itertools.combinations(range(8), 8 - max_bits))
    masks = [sum(0xFF << 8 * p for p in c) for c in choices]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    posted = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).cast("short").alias("slot"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes"))
        for k, m in enumerate(signed)])).alias("p")).select("p.slot", "p.bytes", "fp")

    def run(batches):
        held = None
        for b in itertools.chain(batches, [None]):
            if b is not None:
                new = [b.column(c).to_numpy(zero_copy_only=False) for c in range(3)]
                held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            if held is None or not len(held[0]):
                continue
            slot, key, fp = held[0], held[1], held[2].view(np.uint64)
            starts = np.flatnonzero(np.concatenate([[True], (slot[1:] != slot[:-1]) | (key[1:] != key[:-1])]))
            ends = np.append(starts[1:], len(slot))
            if b is not None:  # the last list may go on in the next batch
                held = [x[starts[-1]:] for x in held]
                starts, ends = starts[:-1], ends[:-1]
            else:
                held = None
            size = ends - starts
            two = starts[size == 2]
            near = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits]
            found = [np.stack([fp[near], fp[near + 1]], 1).reshape(-1, 2)]
            for s, e in zip(starts[size > 2].tolist(), ends[size > 2].tolist()):
                free = tuple(p for p in range(8) if p not in choices[slot[s]])
                found.append(np.array(forest(fp[s:e], free, max_bits), np.uint64).reshape(-1, 2))
            out = np.concatenate(found).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0].copy()), pa.array(out[:, 1].copy())], ["a", "b"])

    lists = posted.repartition("slot", "bytes").sortWithinPartitions("slot", "bytes")
    return lists.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                    id_col: str = "doc_id", text_col: str = "text", keep: str | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Fingerprints within ``max_bits`` bits are linked; component_id is the
    smallest doc_id of all rows reachable over links.  Null and empty texts
    have fingerprint 0 and link like any other.  Repeated rows get a row each;
    a null doc_id takes part with its text but is nobody's component_id, which
    is null only where no row of the component has an id.  Other columns are
    ignored but ``keep``, which comes along with the component's root
    fingerprint; an empty table gives an empty result.
    """
    marked = staged(fingerprints(docs, shingle, id_col, text_col, keep), "fingerprints")
    distinct = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = staged(components(links(distinct.select("fp"), max_bits)), "roots")
    # Fingerprints without a link are their own component; both tables have one row per fingerprint.
    placed = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    # Written before it is joined: a join of two plain shuffles can split a hot component.
    named = staged(placed.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    ids = placed.join(named, "root").select("fp", "component_id", "root")
    return marked.join(ids, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        *(["root", keep] if keep else []))


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of which one of each component stays: that of the smallest id.

    Rows are told apart by their place, so a row goes whose id another
    component's kept row has, and of repeated rows or rows with one id one
    stays.  A row without an id stays only where no row of
    its component has one.  Null and empty texts are alike; texts of any
    length; an empty table gives an empty result.
    """
    row = "__encore_row"
    rows = numbered(docs, row)
    marked = near_duplicates(rows, shingle, max_bits, id_col, text_col, keep=row)
    # The first of each component: smallest id, then first place; components are told by fingerprint root.
    first = marked.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", F.col(row))).alias("f")).select(
        F.col(f"f.{row}").alias("__encore_first"))
    return rows.join(first, F.col(row) == F.col("__encore_first"), "left_semi").drop(row)
