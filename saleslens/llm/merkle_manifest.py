"""Merkle manifest of a dataset in levels kept as hex strings.

Every row is a leaf, every group (language) has a tree over its leaves in the order
of their ids, and the roots of the groups have a tree of their own.  The tree is
cut into aligned blocks of ``2**BLOCK_BITS`` nodes.  A block keeps each of its
levels as one string of concatenated 64-digit digests: the substrings of 128
digits are hashed to the level above, and the sibling of node i is the substring
at i xor 1.  The root of a block is a node of the next round, until one node per
group is left; its path to the root is then handed down to the leaves, block by
block.

How it scales: a text is read once, where it lies; what travels is one digest per
row.  Positions come from a range sort with one offset per range and group, so a
group that holds most rows is spread like the others.  A block has at most
``2**BLOCK_BITS`` nodes whatever the table, and the rounds grow with the logarithm
of the rows.  All levels are built by SQL functions.

Defined results: a NULL column counts as ``-``; a NULL group is a group and comes
first; within a group NULL ids come first, and rows that repeat an id are ordered
by their digests; a group of one row has that leaf as its root; an empty text has
length 0 and differs from NULL; very long texts are hashed whole; an empty table
gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, read

BLOCK_BITS = 8
DIGITS = 64
TAMPER_EVERY = 7
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
PATH = "array<struct<right:boolean,sibling:string>>"


def tagged(value: Column) -> Column:
    """``-`` for NULL, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[tagged(c) for c in columns]), 256)


def numbered(leaves: DataFrame) -> DataFrame:
    """``leaves`` (grp, id, leaf, ...), written, with ``pos``: the place within the group, from 0."""
    order = ["grp", "id", "leaf", "row"]  # the last tells equal rows apart, so that they too are dealt over ranges
    at = F.monotonically_increasing_id()
    placed = materialize(
        leaves.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({"_range": F.shiftright(at, 33), "_at": at}), "merkle-leaves")
    ranges = placed.groupBy("grp", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = W.partitionBy("grp").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    shifts = ranges.select(
        F.col("grp").alias("_g"), F.col("_range").alias("_r"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    joined = placed.join(shifts, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
    return joined.withColumn("pos", F.col("_at") + F.col("_shift")).select(*leaves.columns, "pos")


def node(level: Column, i: Column, width: int = DIGITS) -> Column:
    """The digits of node i (or, with twice the width, of a pair); empty beyond the last."""
    return F.substr(level, (i * width + 1).cast("int"), F.lit(width))


def parents(level: Column) -> Column:
    """The level above: every 128 digits, the last maybe 64, are hashed."""
    pairs = F.ceil(F.length(level) / (2 * DIGITS)).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), pairs - 1), lambda i: F.sha2(node(level, i, 2 * DIGITS), 256)), "")


def blocks(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per aligned block of (grp, pos, h): grp, block, levels, depth, root.

    ``levels`` are the strings from the nodes up; the root is the single node above
    the last of them.  A group that fits into one block stops where one node is
    left, every other block goes up all its levels.
    """
    span = 1 << BLOCK_BITS
    block = F.shiftright("pos", BLOCK_BITS)
    gathered = nodes.groupBy("grp", block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("pos", "h"))).alias("own"))
    known = gathered.join(sizes, F.col("grp").eqNullSafe(F.col("size_of")))
    # Levels until one node is left: the bits of (nodes - 1).
    depth = F.when(F.col("size") <= span, F.ceil(F.log2(F.col("size"))).cast("int")).otherwise(BLOCK_BITS)
    rows = known.select("grp", "block", depth.alias("depth"), F.array_join(F.col("own.h"), "").alias("level_0"))
    # The levels are columns, one after the other, so that each is computed once.
    for k in range(BLOCK_BITS):
        above = F.when(F.col("depth") > k, parents(F.col(f"level_{k}")))
        rows = rows.withColumn(f"level_{k + 1}", above)
    names = [f"level_{k}" for k in range(BLOCK_BITS + 1)]
    return rows.select("grp", "block", "depth", F.array(*names[:-1]).alias("levels"), F.element_at(F.array(*names), F.col("depth") + 1).alias("root"))


def path_in_block(levels: Column, depth: Column, i: Column) -> Column:
    """Side and sibling (empty: none) of node i at each level of its block, from below."""

    def step(k: Column) -> Column:
        at = F.call_function("shiftright", i, k)
        sibling = node(F.get(levels, k), at.bitwiseXOR(F.lit(1)))
        return F.struct((at % 2 == 1).alias("right"), sibling.alias("sibling"))

    return F.when(depth > 0, F.transform(F.sequence(F.lit(0), depth - 1), step)).otherwise(F.array().cast(PATH))


def tree(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trees over written (grp, pos, h): the lowest blocks with the path above each, and (grp, root) of every group.

    A loop over rounds; each has a 2**BLOCK_BITS-th of the nodes of the one before.
    """
    sizes = materialize(nodes.groupBy(F.col("grp").alias("size_of")).agg(F.count(F.lit(1)).alias("size")), "merkle-sizes")
    rounds = [materialize(blocks(nodes, sizes), "merkle-blocks")]
    while True:
        more = sizes.where(F.col("size") > (1 << BLOCK_BITS)).select(
            "size_of", F.ceil(F.col("size") / (1 << BLOCK_BITS)).alias("size"))
        if more.isEmpty():
            break
        sizes = materialize(more, "merkle-sizes")
        # Only the roots of groups with several blocks go on.
        up = rounds[-1].join(sizes.select("size_of"), F.col("grp").eqNullSafe(F.col("size_of")), "left_semi")
        rounds.append(materialize(blocks(up.select("grp", F.col("block").alias("pos"), F.col("root").alias("h")), sizes), "merkle-blocks"))
    above = rounds[-1].select("grp", "block", "depth", "levels", "root", F.array().cast(PATH).alias("up"), F.col("root").alias("top"))
    for k in range(len(rounds) - 2, -1, -1):
        low = rounds[k]
        at = F.col("block").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")
        high = above.select(
            F.col("grp").alias("_g"), F.col("block").alias("_b"), F.col("depth").alias("_depth"), F.col("levels").alias("_levels"),
            F.col("up").alias("_up"), F.col("top").alias("_top"))
        joined = low.join(high, F.col("grp").eqNullSafe(F.col("_g")) & (F.shiftright("block", BLOCK_BITS) == F.col("_b")), "left")
        path = F.concat(path_in_block(F.col("_levels"), F.col("_depth"), at), F.col("_up"))
        above = materialize(joined.select(
            *low.columns, F.when(F.col("_g").isNull() & F.col("_b").isNull(), F.array().cast(PATH)).otherwise(path).alias("up"),
            F.coalesce("_top", "root").alias("top")), "merkle-paths")
    roots = materialize(above.where("block = 0").select("grp", F.col("top").alias("root")), "merkle-roots")
    return above, roots


def with_paths(leaves: DataFrame, lowest: DataFrame) -> DataFrame:
    """``leaves`` with ``path``, from the leaf to its group's root, and ``subroot``."""
    high = lowest.select(
        F.col("grp").alias("_g"), F.col("block").alias("_b"), F.col("depth").alias("_depth"), F.col("levels").alias("_levels"),
        F.col("up").alias("_up"), F.col("top").alias("subroot"))
    joined = leaves.join(high, F.col("grp").eqNullSafe(F.col("_g")) & (F.shiftright("pos", BLOCK_BITS) == F.col("_b")))
    at = F.col("pos").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")
    path = F.concat(path_in_block(F.col("_levels"), F.col("_depth"), at), F.col("_up"))
    return joined.select(*leaves.columns, path.alias("path"), "subroot")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(
        F.when(s["right"], F.concat(s["sibling"], h)).otherwise(F.concat(h, s["sibling"])), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: s["sibling"]), ""), 256)


def manifest(leaves: DataFrame) -> DataFrame:
    """``leaves`` (grp, id, leaf, row, ...) with path (to the root of all), subroot and root."""
    placed = numbered(leaves)
    lowest, roots = tree(placed.select("grp", "pos", F.col("leaf").alias("h")))
    # One row per group: the tree above is built in the same way, as a group of its own.
    one = F.lit("all")
    top = numbered(roots.select(one.alias("grp"), F.col("grp").alias("id"), F.col("root").alias("leaf"), F.lit(0).cast("bigint").alias("row")))
    top = materialize(top, "merkle-top")
    top_blocks, _ = tree(top.select("grp", "pos", F.col("leaf").alias("h")))
    above = materialize(with_paths(top, top_blocks).select(
        F.col("id").alias("_grp"), F.col("path").alias("_path"), F.col("subroot").alias("root")), "merkle-top-paths")
    joined = with_paths(placed, lowest).join(above, F.col("grp").eqNullSafe(F.col("_grp")))
    return joined.withColumn("path", F.concat("path", "_path")).drop("_grp", "_path", "pos")


def audited(docs: DataFrame) -> DataFrame:
    """One row per document: its manifest entry, and the check of its row as it would come back from the rows tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    own = [F.col(c) for c in COLUMNS]
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in COLUMNS]
    leaves = materialize(docs.select(
        F.col("lang").alias("grp"), F.col("doc_id").alias("id"), leaf_of(own).alias("leaf"),
        F.when(tampered, leaf_of(changed)).alias("changed"), F.monotonically_increasing_id().alias("row")), "merkle-rows")
    out = manifest(leaves).withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return out.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return audited(read(spark, sf_dir, "documents"))


def _tag_sql(name: str, value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || ({value}::VARCHAR), '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_tag_sql(c, n_chars if c == "n_chars" else c) for c in COLUMNS) + ")"


#: The reflected polynomial of CRC-32 is a fixed value.
_CRC_SQL = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
  lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda b, z: CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END), 4294967295::BIGINT), 4294967295::BIGINT)"""

OP13_SQL = f"""
WITH RECURSIVE marked AS (
  SELECT *, coalesce({_CRC_SQL} % {TAMPER_EVERY} = 0, false) AS tampered FROM documents),
leaves AS (
  SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf, CASE WHEN tampered THEN {_leaf_sql('(n_chars + 1)')} END AS changed FROM marked),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
nodes AS (
  SELECT lang, 0 AS level, pos, leaf AS h FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS m FROM nodes) WHERE m > 1 GROUP BY lang, level, pos // 2),
subroots AS (SELECT lang, h AS subroot, level AS height FROM nodes QUALIFY row_number() OVER (PARTITION BY lang ORDER BY level DESC) = 1),
tops AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM subroots),
upper_nodes AS (
  SELECT 0 AS level, pos, subroot AS h FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS m FROM upper_nodes) WHERE m > 1 GROUP BY level, pos // 2),
root AS (SELECT h AS root, level AS height FROM upper_nodes ORDER BY level DESC LIMIT 1),
rows AS (
  SELECT p.doc_id, p.lang, p.pos, p.leaf, coalesce(p.changed, p.leaf) AS given, t.subroot, t.height, t.pos AS top_pos, r.root, r.height AS top_height
  FROM placed p JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang CROSS JOIN root r),
fold AS (
  SELECT lang, pos, 0 AS step, given AS h, '' AS proof FROM rows
  UNION ALL
  SELECT f.lang, f.pos, f.step + 1,
         sha256(CASE WHEN (spot.place >> spot.level) & 1 = 1 THEN coalesce(n.h, u.h, '') || f.h ELSE f.h || coalesce(n.h, u.h, '') END),
         f.proof || coalesce(n.h, u.h, '')
  FROM fold f JOIN rows r ON f.lang IS NOT DISTINCT FROM r.lang AND f.pos = r.pos
  CROSS JOIN LATERAL (SELECT f.step < r.height AS below, CASE WHEN f.step < r.height THEN f.step ELSE f.step - r.height END AS level,
                             CASE WHEN f.step < r.height THEN r.pos ELSE r.top_pos END AS place) spot
  LEFT JOIN nodes n ON spot.below AND n.lang IS NOT DISTINCT FROM f.lang AND n.level = spot.level AND n.pos = xor(spot.place >> spot.level, 1)
  LEFT JOIN upper_nodes u ON NOT spot.below AND u.level = spot.level AND u.pos = xor(spot.place >> spot.level, 1)
  WHERE f.step < r.height + r.top_height)
SELECT r.doc_id, r.leaf, r.subroot, r.root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = r.root AS verified
FROM rows r JOIN fold f ON r.lang IS NOT DISTINCT FROM f.lang AND r.pos = f.pos AND f.step = r.height + r.top_height
"""
