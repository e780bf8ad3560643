"""Best-fit packing of documents into sequences of at most ``max_len`` tokens.

Pieces are dealt to groups of bounded size; each group starts from a best-fit
packing and improves it by swap-based local search: between two underfull
bins a document moves, or one or two documents are exchanged for one, where
that raises the sum of squared fills, so that the emptier bin drains until it
is empty.  Bins that stay clearly underfull are pooled over the groups and
packed once more.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .storage import staged

#: Rows of a group: about 1 MB in a task, however many rows there are in all.
GROUP_ROWS = 25_000
#: Bins filled to less than this share are packed again across groups.
POOL_BELOW = 0.9


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 0, max_len: int = 2048,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and end id, cut where longer than ``max_len``.

    Null or empty text: the end id alone.  Repeated rows and null ids give their own pieces.
    """
    file = docs.sparkSession.sparkContext.broadcast(tx.read_file(tokenizer_path))

    def cut(batches):
        chunks, end, step = tx.word_encoder(file.value), np.array([end_id], "<u4").tobytes(), 4 * max_len
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, t in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
                ids = tx.encode_ids(chunks, t) + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    row.append(i), piece.append(k), start.append(at // 4)
                    length.append(len(part) // 4), crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    src = tx.id_text(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(lengths: list[int], cap: int) -> list[list[int]]:
    """Items, longest first, each into the fullest bin that holds it."""
    bins, by_room, rooms = [], [[] for _ in range(cap + 1)], 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(i)
        else:
            b, room = len(bins), cap
            bins.append([i])
        by_room[room - n].append(b)
        rooms |= 1 << (room - n)
    return bins


def _best_exchange(out_items, out_sizes, size, bin_of, fill, s, cap):
    """The exchange out of bin ``s`` with the largest gain in squared fill, as (out, into, partner item or -1).

    ``out_items``: one or two items of ``s`` each; they move to another bin,
    alone or against one item of it.  A shift of d tokens from s to j gains
    2 d (d + fill_j - fill_s).
    """
    best, found = 0, None
    for items, total in zip(out_items, out_sizes):
        if len(items) == 1:  # move
            gain = np.where((fill > 0) & (fill + total <= cap), 2 * total * (total + fill - fill[s]), 0)
            gain[s] = 0
            j = int(gain.argmax())
            if gain[j] > best:
                best, found = gain[j], (items, j, -1)
        shift, to = total - size, fill[bin_of]  # one for one, two for one
        gain = np.where((shift > 0) & (to + shift <= cap) & (bin_of != s) & (to > 0),
                        2 * shift * (shift + to - fill[s]), 0)
        k = int(gain.argmax()) if len(gain) else 0
        if len(gain) and gain[k] > best:
            best, found = gain[k], (items, int(bin_of[k]), k)
    return found


def local_search(bins: list[list[int]], lengths: list[int], cap: int) -> list[list[int]]:
    """Drain the emptiest underfull bins by exchanges until none can be emptied any more.

    Every exchange raises the sum of squared fills, so it ends; a bin is tried
    only while the others have room for all it holds.
    """
    fills = [sum(lengths[i] for i in b) for b in bins]
    live = [b for b in range(len(bins)) if fills[b] < cap]
    if len(live) < 2:
        return bins
    items = [i for b in live for i in bins[b]]
    place = {i: k for k, i in enumerate(items)}
    size = np.array([lengths[i] for i in items], np.int64)
    bin_of = np.repeat(np.arange(len(live)), [len(bins[b]) for b in live])
    fill = np.array([fills[b] for b in live], np.int64)
    held = [set(bins[b]) for b in live]
    emptied = True
    while emptied:
        emptied = False
        for s in np.argsort(fill, kind="stable").tolist():
            if not held[s]:
                continue
            if int((cap - fill[fill > 0]).sum()) - (cap - int(fill[s])) < int(fill[s]):
                break
            while held[s]:
                own = sorted(held[s], key=lambda i: (-lengths[i], i))
                out = [(a,) for a in own] + [(a, c) for x, a in enumerate(own) for c in own[x + 1:]]
                found = _best_exchange(out, [sum(lengths[i] for i in o) for o in out], size, bin_of, fill, s, cap)
                if found is None:
                    break
                gone, j, partner = found
                for i in gone:
                    bin_of[place[i]] = j
                    held[s].remove(i), held[j].add(i)
                    fill[s], fill[j] = fill[s] - lengths[i], fill[j] + lengths[i]
                if partner >= 0:
                    i = items[partner]
                    bin_of[partner] = s
                    held[j].remove(i), held[s].add(i)
                    fill[s], fill[j] = fill[s] + lengths[i], fill[j] - lengths[i]
            emptied |= not held[s]
    full = [b for k, b in enumerate(bins) if fills[k] >= cap]
    return full + [sorted(h) for h in held if h]


def _pack_groups(items: DataFrame, rows: int, max_len: int, level: int) -> DataFrame:
    """Pack each group of about ``GROUP_ROWS`` rows; adds sequence_id, offset and the sequence's fill."""
    groups = max(1, -(-rows // GROUP_ROWS))
    dealt = items.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def pack(table: pa.Table) -> pa.Table:
        lengths = table["length"].to_pylist()
        base = level << 56 | table["grp"][0].as_py() << 28
        seq, offset, filled = ([0] * len(lengths) for _ in range(3))
        for k, b in enumerate(local_search(best_fit(lengths, max_len), lengths, max_len)):
            at = 0
            for i in b:
                seq[i], offset[i] = base + k, at
                at += lengths[i]
            for i in b:
                filled[i] = at
        table = table.drop_columns(["grp"])
        for name, values in (("sequence_id", seq), ("offset", offset), ("filled", filled)):
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    return dealt.groupBy("grp").applyInArrow(pack, schema + ", sequence_id bigint, offset bigint, filled bigint")


def pack(items: DataFrame, max_len: int = 2048) -> DataFrame:
    """``items`` (any columns, ``length`` from 1 to ``max_len``) with sequence_id and offset added.

    Every row comes back once; a sequence's lengths sum to at most ``max_len``
    and its offsets run gapless from 0.  Rows are dealt to groups by position,
    so equal rows or a repeated document spread like any others.  An empty
    table gives an empty result.
    """
    items = staged(items, "pieces")
    first = staged(_pack_groups(items, items.count(), max_len, 0), "packed")
    low = first.where(F.col("filled") < POOL_BELOW * max_len).select(*items.columns)
    again = _pack_groups(low, low.count(), max_len, 1)
    return first.where(F.col("filled") >= POOL_BELOW * max_len).unionByName(again).drop("filled")


def packed_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, max_len: int = 2048,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents tokenized, cut and packed: (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    return pack(pieces(docs, tokenizer_path, end_id, max_len, id_col, text_col), max_len)
