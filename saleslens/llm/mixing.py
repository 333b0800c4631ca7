"""Mixing sources to target weights.

Every row gets a hash-random key.  Within a source the keys are cut into ranges,
the ranges' token counts are summed up (a distributed prefix sum), and the source
is cut where the running sum reaches its budget.  Only the one range in which the
cut falls is sorted; ranges before it are taken whole.  A budget above the size
of a source repeats whole epochs first and cuts in a fresh random order.

No source is ever in one task: sizes are pre-aggregated by (source, range), and
the number of ranges follows the rows of the source.

A row's key is the hash of its id.  Rows that share an id within a source, or have
none, are numbered by size, and the number goes into the hash: they are drawn one
by one like the others, also where one id stands on a third of all rows.

Defined results: NULL text has size 0; a NULL source is a source of its own and
comes last; rows of one id and size stand for each other; an empty table gives no
rows; a source of size 0 has target 0; a size of 0 takes no words; very long texts
are counted whole.  Only the named columns are used, others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import KEY_BITS, hash_key, materialize, prefix_sums, read

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, MAX_EPOCHS, SEED = 1.5, 2, 17
#: Rows a range is meant to hold; it sets the work of the one sorted range, not the result.
RANGE_ROWS = 4096


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, rows, source_size, target.

    Targets are proportional to the weights, dealt to the sources in code point
    order, but none is above ``max_epochs`` times its source; what that frees is
    shared again by weight.  So target = least(cap, level * weight), and the level
    follows from prefix sums in the order of cap / weight.
    """
    totals = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    ranked = prefix_sums(totals, ["source"], {"_index": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("_index") - 1) % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * max_epochs)
    capped = capped.withColumn("_ratio", F.col("_cap") / F.col("_w"))
    summed = materialize(
        prefix_sums(capped, ["_ratio", "source"], {"_caps": F.col("_cap"), "_ws": F.col("_w")}), "water")
    whole = summed.agg(F.sum("source_size").alias("s"), F.sum("_w").alias("w"))
    left = F.lit(share) * whole.select("s").scalar() - (F.col("_caps") - F.col("_cap"))
    level = left / (whole.select("w").scalar() - (F.col("_ws") - F.col("_w")))
    found = summed.select("_ratio", "_ws", level.alias("_level")).where("_level <= _ratio")
    at = found.agg(F.min(F.struct("_ratio", "_ws", "_level")).alias("f")).select("f._level").scalar()
    return summed.select(
        "source", "rows", "source_size", F.least(F.col("_cap").cast("double"), at * F.col("_w")).alias("target"))


def cuts(sizes: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """``plan`` with epochs, budget and the key and id of the last row that the cut takes."""
    size = F.greatest(F.col("source_size"), F.lit(1))
    epochs = F.floor(F.col("target") / size)
    bits = F.ceil(F.log2(F.greatest(F.col("rows") / RANGE_ROWS, F.lit(1.0)))).cast("int")
    plan = materialize(
        plan.withColumn("epochs", epochs).withColumn("bits", bits)
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-plan")
    keyed = (
        sizes.select("doc_id", "nth", "size", F.col("source").alias("_source"))
        .join(plan.where("budget > 0").select("source", "epochs", "bits", "budget"), F.col("_source").eqNullSafe(F.col("source")))
        .withColumn("key", row_key(seed, F.col("epochs")))
        .withColumn("range", range_of(F.col("key"), F.col("bits"))))
    totals = keyed.groupBy("source", "range", "budget").agg(F.sum("size").alias("total"))
    upto = F.sum("total").over(W.partitionBy("source").orderBy("range"))
    crossed = (
        totals.withColumn("before", upto - F.col("total"))
        .where("before < budget and budget <= before + total")
        .select(F.col("source").alias("_at"), F.col("range").alias("_range"), "before"))
    units = (
        keyed.join(crossed, F.col("source").eqNullSafe(F.col("_at")) & (F.col("range") == F.col("_range")))
        .groupBy("source", "range", "budget", "before", "key", "doc_id", "nth").agg(F.sum("size").alias("total")))
    running = F.sum("total").over(W.partitionBy("source", "range").orderBy("key", "doc_id", "nth"))
    taken = (
        units.withColumn("start", F.col("before") + running - F.col("total"))
        # The row that crosses the budget is taken if that ends nearer to it.
        .where("start < budget and start + total / 2 <= budget"))
    last = taken.groupBy(F.col("source").alias("_cut_source"), F.col("range").alias("_cut_range")).agg(
        F.max(F.struct("key", "doc_id", "nth")).alias("last"))
    at = crossed.select("_at", F.col("_range").alias("cut_range")).join(
        last, F.col("_at").eqNullSafe(F.col("_cut_source")), "left").select("_at", "cut_range", "last")
    return materialize(plan.join(at, F.col("source").eqNullSafe(F.col("_at")), "left").drop("_at"), "mix-cuts")


def range_of(key: Column, bits: Column) -> Column:
    return F.call_function("shiftright", key, F.lit(KEY_BITS) - bits)


def row_key(seed: int, epochs: Column) -> Column:
    """The hash-random key of a row (doc_id, nth); nth is 0 where no other row of the source has the id."""
    alone = hash_key(F.lit(seed), epochs, F.col("doc_id"))
    return F.when(F.col("nth") == 0, alone).otherwise(hash_key(F.lit(seed), epochs, F.col("doc_id"), F.col("nth")))


def numbered(rows: DataFrame) -> DataFrame:
    """Written ``rows`` (row, doc_id, source, size, ...) with ``nth``: the place among rows of the same source and id, 0 if alone.

    The numbers are prefix sums over ranges, so an id on very many rows is spread.
    """
    repeats = materialize(
        rows.groupBy(F.col("source").alias("_s"), F.col("doc_id").alias("_d")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeats")
    if repeats.isEmpty():
        return rows.withColumn("nth", F.lit(0).cast("bigint"))
    same = F.col("source").eqNullSafe(F.col("_s")) & F.col("doc_id").eqNullSafe(F.col("_d"))
    several = rows.select("row", "doc_id", "source", "size").join(repeats, same, "left_semi")
    counted = materialize(prefix_sums(several, ["source", "doc_id", "size", "row"], {"at": F.lit(1)}), "counted")
    first = counted.groupBy(F.col("source").alias("_s"), F.col("doc_id").alias("_d")).agg(F.min("at").alias("first"))
    places = materialize(counted.join(first, same).select(F.col("row").alias("_r"), (F.col("at") - F.col("first") + 1).alias("nth")), "places")
    return rows.join(places, F.col("row") == F.col("_r"), "left").drop("_r").withColumn("nth", F.coalesce("nth", F.lit(0)))


def with_copies(rows: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """``rows`` (doc_id, nth, source, ...) with source_size, target and copies (how often the mix takes the row)."""
    p = plan.select(F.struct(F.col("source").alias("name"), *[c for c in plan.columns if c != "source"]).alias("_p"))
    key = row_key(seed, F.col("_p.epochs"))
    at = F.struct(key.alias("key"), F.col("doc_id"), F.col("nth"))
    place = range_of(key, F.col("_p.bits"))
    cut = F.col("_p.cut_range")
    # Structs order NULL first, as the cut does.
    inside = F.coalesce((place < cut) | ((place == cut) & (at <= F.col("_p.last"))), F.lit(False))
    joined = rows.join(p, F.col("source").eqNullSafe(F.col("_p.name")))
    return joined.select(
        *rows.columns, F.col("_p.source_size").alias("source_size"), F.col("_p.target").alias("target"),
        (F.col("_p.epochs") + inside.cast("int")).cast("int").alias("copies"))


def mix(docs: DataFrame, own: bool = False) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, and with ``own`` the input row as a struct."""
    kept = [F.struct(*docs.columns).alias("own")] if own else []
    rows = materialize(docs.select(
        *kept, "doc_id", "source", words(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("row")), "sizes")
    placed = numbered(rows)
    return with_copies(placed, cuts(placed, targets(rows)))


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    out = mix(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    out = mix(docs, own=True).where("copies > 0")
    return out.select("own", F.explode(F.sequence(F.lit(1), "copies"))).select("own.*")


OP6_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
totals AS (SELECT source, count(*) AS n, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS w, 2 * source_size AS cap FROM totals),
water AS (
  SELECT *, cap / w AS ratio, sum(cap) OVER o AS caps, sum(w) OVER o AS ws,
         1.5::DOUBLE * sum(source_size) OVER () AS goal, sum(w) OVER () AS all_w
  FROM weighed WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
levels AS (SELECT *, (goal - (caps - cap)) / (all_w - (ws - w)) AS level FROM water),
plan AS (
  SELECT source, n, source_size, least(cap::DOUBLE, (SELECT arg_min(level, ws) FROM levels WHERE level <= ratio) * w) AS target
  FROM levels),
epochs AS (SELECT *, floor(target / greatest(source_size, 1))::BIGINT AS epochs FROM plan),
places AS (
  SELECT *, count(*) OVER w AS same, row_number() OVER (PARTITION BY source, doc_id ORDER BY size) AS nth FROM sizes WINDOW w AS (PARTITION BY source, doc_id)),
keyed AS (
  SELECT s.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS budget,
         ('0x' || substr(md5('17:' || e.epochs || ':' || coalesce(s.doc_id::VARCHAR, 'null') || CASE WHEN same > 1 THEN ':' || nth ELSE '' END), 1, 15))::BIGINT AS key
  FROM places s JOIN epochs e ON s.source IS NOT DISTINCT FROM e.source),
summed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, nth ROWS UNBOUNDED PRECEDING) - size AS start FROM keyed)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN start < budget AND start + size / 2 <= budget THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""
