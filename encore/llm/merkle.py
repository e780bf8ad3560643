"""Merkle dataset manifest: leaf places by bitmap rank, levels reduced over keyed slot arrays.

A row is a leaf; the leaves of a group (a source) ascend by id.  Their places
come from rank queries instead of a sort: ids set bits in per-group bitmaps
kept as 64-bit words, empty words left out; a directory of counts (words of
a container of 65,536 ids, containers, and two coarser levels, each a
running sum over at most 65,536 entries) gives what lies before a word, and
the population count of the bits below gives the rest.  Ids that occur more
than once are ranked further by leaf digest and then by row, the same way.

Leaves then meet in slot arrays of 4,096 places, keyed by (group, place >>
12), which reduce by three levels of sixteen at once; so do the nodes that
remain, and the groups' roots in turn.  The way back down hands each array the
siblings above it, so every leaf's proof is folded without a join per level.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import row_number
from . import text as tx
from .storage import staged

#: Fixed value of the contract: children of a node.
FAN = 16
#: Levels that one slot array reduces: 16**3 = 4,096 places.
LEVELS = 3
_SHIFT = 4 * LEVELS
#: Before the word of any 64-bit id: where null ids go.
_NULL_WORD = -(1 << 57) - 1
#: Bits of the directory levels above a word: containers of 1,024 words, then 65,536 of the level below.
_DIRECTORY = (10, 16, 16)

_NODE = "tree bigint, slot bigint, digest string, depth int"
_ABOVE = "tree bigint, slot bigint, path array<string>, subroot string"
_PROOF = "doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


# ----------------------------------------------------------------- leaves
def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """Hex sha256 of the values, each ``-`` if null, else byte count, colon, value."""
    return F.sha2(F.concat(*map(_field, values)), 256)


def _leaves(docs: DataFrame, id_col: str, group_col: str, other_cols: tuple, text_col: str) -> DataFrame:
    """(doc_id, source, leaf, changed, row): changed is the digest of a tampered leaf, row a number of its own."""
    names = (id_col, group_col, *other_cols, text_col)
    src = docs.select(*[tx.col(c).alias(f"c{k}") for k, c in enumerate(names)])
    cols = [F.col(f"c{k}") for k in range(len(names))]
    picked = F.crc32(cols[0].cast("string")) % 5 == 0  # null for a null id: not tampered with
    return src.select(
        cols[0].alias("doc_id"), cols[1].cast("string").alias("source"), leaf_digest(*cols).alias("leaf"),
        F.when(picked, leaf_digest(*cols[:-1], tx.ascii_lower(cols[-1]))).alias("changed"),
        F.monotonically_increasing_id().alias("row"))


# ----------------------------------------------------------------- places by rank
def _same(left: list[str], right: list[str]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def _renamed(df: DataFrame, names: list[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in names})


def _running(df: DataFrame, group: list[str], part: str, order: str, name: str) -> DataFrame:
    before = Window.partitionBy(*group, part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum("n").over(before), F.lit(0)))


def bitmap_words(rows: DataFrame, group: list[str], key: str) -> DataFrame:
    """(group, word, bits, n, more, before): the groups' bitmaps over ``key`` with their directory.

    ``n`` rows have keys in the word, ``before`` in earlier ones; ``more`` lists
    (bit, repeats) of the keys in it that occur more than once.
    """
    at = rows.select(*group, _word(key).alias("word"), _bit(key).alias("bit"))
    words = staged(at.groupBy(*group, "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"),
                                                  F.count(F.lit(1)).alias("n")), "bitmap-words")
    # Repeated keys: only the rows in words with more rows than bits are looked at.
    crowded = _renamed(words.where("n > bit_count(bits)").select(*group, "word"), [*group, "word"], "c_")
    repeats = at.join(crowded, _same([*group, "word"], [f"c_{c}" for c in (*group, "word")]), "left_semi").groupBy(
        *group, "word", "bit").agg(F.count(F.lit(1)).alias("n")).where("n > 1").groupBy(*group, "word").agg(
        F.collect_list(F.struct("bit", (F.col("n") - 1).alias("n"))).alias("more"))
    words = words.join(_renamed(repeats, [*group, "word"], "r_"),
                       _same([*group, "word"], [f"r_{c}" for c in (*group, "word")]), "left").select(
        *group, "word", "bits", "n", "more")
    # The directory, bottom up: running sums within each entry of the level above.
    levels, now, key_now = [], words, "word"
    for k, bits in enumerate(_DIRECTORY):
        part = f"k{k}"
        now = _running(now.withColumn(part, F.shiftright(key_now, bits)), group, part, key_now, "before")
        levels.append((now, key_now, part))
        now, key_now = now.groupBy(*group, part).agg(F.sum("n").alias("n")), part
    top = _running(now.withColumn("all", F.lit(0)), group, "all", key_now, "before").select(*group, key_now, "before")
    for level, own, part in reversed(levels):
        names = [*group, part]
        above = _renamed(top, [*names, "before"], "a_")
        cols = [*group, own] + (["bits", "n", "more"] if own == "word" else [])
        top = level.join(above, _same(names, [f"a_{c}" for c in names])).select(
            *cols, (F.col("before") + F.col("a_before")).alias("before"))
    return top


def _word(key: str) -> Column:
    return F.coalesce(F.shiftright(F.col(key).cast("bigint"), 6), F.lit(_NULL_WORD))


def _bit(key: str) -> Column:
    return F.coalesce(F.col(key).cast("bigint").bitwiseAND(F.lit(63)), F.lit(0)).cast("int")


def ranked(rows: DataFrame, group: list[str], keys: list[str], name: str = "slot") -> DataFrame:
    """``rows`` and each one's place from 0 among its group's rows by ``keys``, smallest first, null before all.

    ``keys`` are integers; the last must tell rows apart.  Groups, whatever
    their size, are spread by word; nothing is sorted as a whole.
    """
    words = _renamed(bitmap_words(rows, group, keys[0]), [*group, "word"], "w_")
    cond = _same(group, [f"w_{c}" for c in group]) & (_word(keys[0]) == F.col("w_word"))
    placed = rows.withColumn("bit", _bit(keys[0])).join(words, cond)
    below = F.expr("bit_count(bits & ~shiftleft(-1L, bit))").cast("bigint")
    more = F.expr("coalesce(aggregate(filter(more, x -> x.bit < bit), 0L, (s, x) -> s + x.n), 0L)")
    placed = placed.select(*rows.columns, (F.col("before") + below + more).alias(name),
                           F.expr("coalesce(exists(more, x -> x.bit = bit), false)").alias("tied"))
    if len(keys) == 1:
        return placed.drop("tied")
    placed = staged(placed, "ranked")
    ties = placed.where("tied").drop("tied")
    if ties.isEmpty():
        return placed.drop("tied")
    among = f"{name}_{len(keys)}"
    again = ranked(ties, [*group, keys[0]], keys[1:], among)
    return placed.where("NOT tied").drop("tied").unionByName(
        again.withColumn(name, F.col(name) + F.col(among)).drop(among))


# ----------------------------------------------------------------- levels over slot arrays
def _depth(n: Column) -> Column:
    """Levels until one of ``n`` nodes remains."""
    return sum((F.when(n > F.lit(FAN ** k).cast("bigint"), 1).otherwise(0) for k in range(15)), F.lit(0)).cast("int")


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels(digests: list[str], depth: int) -> list[list[str]]:
    """A slot array's digests and those of ``depth`` levels above them."""
    out = [digests]
    for _ in range(depth):
        last = out[-1]
        out.append([_hash("".join(last[i:i + FAN])) for i in range(0, len(last), FAN)])
    return out


def siblings(held: list[list[str]], k: int) -> list[str]:
    """What stands left and right of the ``k``-th node at each level below the array's top, alternating."""
    path = []
    for digests in held[:-1]:
        run = k // FAN * FAN
        path += ["".join(digests[run:k]), "".join(digests[k + 1:run + FAN])]
        k //= FAN
    return path


def _in_order(table: pa.Table) -> tuple[pa.Table, list[list[str]]]:
    table = table.sort_by("slot")
    return table, levels(table["digest"].to_pylist(), min(LEVELS, table["depth"][0].as_py()))


def _keyed(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("slot", _SHIFT))


def _up(nodes: DataFrame) -> DataFrame:
    """The nodes that the slot arrays of ``nodes`` reduce to."""
    def run(key, table):
        _, held = _in_order(table)
        return pa.table({"tree": [key[0].as_py()], "slot": [key[1].as_py()], "digest": held[-1],
                         "depth": pa.array([max(0, table["depth"][0].as_py() - LEVELS)], pa.int32())})

    rows = _keyed(nodes.select("tree", "slot", "digest", "depth"))
    return rows.groupBy("tree", "block").applyInArrow(run, _NODE)


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and what they reduce to, round by round, down to one node a tree."""
    out = [nodes]
    while (out[-1].agg(F.max("depth")).first()[0] or 0) > 0:
        out.append(staged(_up(out[-1]), "merkle-nodes"))
    return out


def _down(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, slot, path, subroot) of ``nodes``, ``above`` having them for their slot arrays."""
    def run(key, table, over):
        table, held = _in_order(table)
        up = over["path"][0].as_py()
        return pa.table({
            "tree": table["tree"], "slot": table["slot"],
            "path": pa.array([siblings(held, k) + up for k in range(table.num_rows)], pa.list_(pa.string())),
            "subroot": pa.array(over["subroot"].to_pylist() * table.num_rows, pa.string())})

    return _keyed(nodes).groupBy("tree", "block").cogroup(above.groupBy("tree", "slot")).applyInArrow(run, _ABOVE)


def _proofs(leaves: DataFrame, above: DataFrame, root: str, schema: str) -> DataFrame:
    def run(key, table, over):
        table, held = _in_order(table)
        up, proofs, folded = over["path"][0].as_py(), [], []
        rest = "".join(up)
        for k, (leaf, changed) in enumerate(zip(held[0], table["changed"].to_pylist())):
            path = siblings(held, k)
            proofs.append(_hash("".join(path) + rest))
            node = changed or leaf
            path += up
            for left, right in zip(path[::2], path[1::2]):
                node = _hash(left + node + right)
            folded.append(node)
        n = table.num_rows
        return pa.table({"doc_id": table["doc_id"], "leaf": table["digest"],
                         "subroot": over["subroot"].to_pylist() * n, "root": [root] * n, "proof_sha256": proofs,
                         "folded_root": folded, "verified": [x == root for x in folded]})

    return _keyed(leaves).groupBy("tree", "block").cogroup(above.groupBy("tree", "slot")).applyInArrow(run, schema)


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", other_cols: tuple = ("lang", "n_chars"),
             text_col: str = "text") -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``id_col`` is an integer.  Null values are hashed as ``-``.  Within a group
    rows ascend by id, null ids first, equal ids by leaf digest; equal rows
    get a leaf and a place each.  A null group is a group of its own, before
    the others.  Rows whose id's crc32 is divisible by 5 are checked with their
    text's A-Z lower-cased (not those without an id); a text without A-Z, empty
    or null, stays as it is and verifies.  A text's length bounds nothing but
    its own hash.  Other columns are ignored; an empty table has no root and
    gives an empty result.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    schema = _PROOF.format(kind=kind)
    leaves = staged(_leaves(docs, id_col, group_col, other_cols, text_col), "merkle-leaves")
    if leaves.isEmpty():
        return spark.createDataFrame([], schema)
    # 60 bits of a digest each: as integers that order leaves as their digests do.
    digits = {f"digest{k}": F.conv(F.substring("leaf", 15 * k + 1, 15), 16, 10).cast("bigint") for k in range(2)}
    placed = ranked(leaves.withColumns(digits), ["source"], ["doc_id", *digits, "row"]).drop(*digits)
    trees = leaves.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    trees = staged(row_number(trees, [], [F.col("source").asc_nulls_first()], "tree").select(
        F.col("source").alias("of"), (F.col("tree") - 1).cast("bigint").alias("tree"), _depth(F.col("n")).alias("depth")),
        "merkle-trees")
    nodes = staged(placed.join(trees, F.col("source").eqNullSafe(F.col("of"))).select(
        "tree", "slot", F.col("leaf").alias("digest"), "depth", "doc_id", "changed"), "merkle-places")
    low = _rounds(nodes)
    many = trees.agg(F.count(F.lit(1)).alias("trees"), F.max("depth").alias("d")).first()
    subroots = staged(low[-1].select(F.lit(0).cast("bigint").alias("top"), "tree", "digest"), "merkle-subroots")
    top = _rounds(subroots.select(F.col("top").alias("tree"), F.col("tree").alias("slot"), "digest",
                                  _depth(F.lit(many.trees)).alias("depth")))
    root = top[-1].first().digest
    above = spark.createDataFrame([(0, 0, [], None)], _ABOVE)
    for nodes_of in reversed(top[:-1]):
        above = staged(_down(nodes_of, above), "merkle-paths")
    above = staged(above.join(_renamed(subroots, ["tree"], "s_"), F.col("slot") == F.col("s_tree")).select(
        F.col("slot").alias("tree"), F.lit(0).cast("bigint").alias("slot"), "path", F.col("digest").alias("subroot")),
        "merkle-paths")
    for nodes_of in reversed(low[1:-1]):
        above = staged(_down(nodes_of, above), "merkle-paths")
    return _proofs(nodes, above, root, schema)


def _sql_tree(name: str, leaves: str) -> str:
    """Levels, runs of sixteen and each leaf's walk to the top of the trees in ``leaves`` (tree, place, digest, n, node)."""
    return f"""
{name}_up AS (
  SELECT tree, 0 AS level, place, digest, n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 15) // 16
  FROM {name}_up WHERE n > 1 GROUP BY tree, level, place // 16),
{name}_runs AS (SELECT tree, level, place // 16 AS run, list(digest ORDER BY place) AS d FROM {name}_up WHERE n > 1 GROUP BY ALL),
{name}_walk AS (
  SELECT tree, place AS leaf_place, 0 AS level, place, '' AS path, []::VARCHAR[][] AS steps FROM {leaves}
  UNION ALL
  SELECT w.tree, leaf_place, w.level + 1, run, path || {_LEFT} || {_RIGHT}, list_append(steps, [{_LEFT}, {_RIGHT}])
  FROM {name}_walk w JOIN {name}_runs r ON r.tree = w.tree AND r.level = w.level AND r.run = w.place // 16),
{name}_paths AS (SELECT tree, leaf_place, arg_max(path, level) AS path, arg_max(steps, level) AS steps FROM {name}_walk GROUP BY ALL)"""


_LEFT = "array_to_string(d[:place % 16], '')"
_RIGHT = "array_to_string(d[place % 16 + 2:], '')"


def _sql_leaf(text: str) -> str:
    def field(v):
        return f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}::VARCHAR) || ':' || {v} END"
    return f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Unsigned crc32 of an ASCII string as SQL.
_CRC_TABLE = ("list_transform(range(256), lambda x: list_reduce([x, 0, 1, 2, 3, 4, 5, 6, 7], lambda c, k: "
              "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))")

#: The same rows by sorted places and recursive levels.
SQL = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS t),
picked AS (
  SELECT d.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0 AS tampered FROM documents d, crc),
hashed AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {_sql_leaf('text')}) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS n, {_sql_leaf('text')} AS digest,
         CASE WHEN tampered THEN {_sql_leaf(_LOWER)} ELSE {_sql_leaf('text')} END AS node
  FROM picked),{_sql_tree('low', 'hashed')},
subroots AS (SELECT 0 AS tree, tree AS place, digest, count(*) OVER () AS n FROM low_up WHERE n = 1),{_sql_tree('top', 'subroots')},
root AS (SELECT digest FROM top_up WHERE n = 1),
folded AS (
  SELECT h.doc_id, h.digest AS leaf, s.digest AS subroot, root.digest AS root, sha256(l.path || t.path) AS proof_sha256,
         list_reduce(list_concat([[node]], list_concat(l.steps, t.steps)), lambda a, x: [sha256(x[1] || a[1] || x[2])])[1] AS folded_root
  FROM hashed h JOIN subroots s ON s.place = h.tree JOIN low_paths l ON l.tree = h.tree AND l.leaf_place = h.place
  JOIN top_paths t ON t.leaf_place = h.tree, root)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
