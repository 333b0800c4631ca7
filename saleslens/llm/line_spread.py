"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate.  Every line hash carries a
HyperLogLog sketch of its sites; map tasks build partial sketches and the shuffle
merges them, so a line on a third of all rows is one row per task.  Lines whose
estimate lies near the threshold get an exact count of distinct sites before they
are judged.  All occurrences of a boilerplate line go, except the first one (the
smallest document id, then position), so that content which was copied to many
sites is kept once.

Texts are split into lines once; what the counts need of each line, some forty
bytes, is written.  A second pass over the texts puts those together again that lose
lines.

Defined results: lines are compared with outer white space cut off; blank lines
are never removed; NULL text stays NULL and has 0 lines; NULL sites are not
counted; a NULL doc_id goes before all others; documents are told apart by id and
text, so rows that repeat both are treated alike, and where different texts repeat
an id the hash of the text decides which place is the first; a document all of whose
lines go keeps an empty text; very long texts and lines are taken whole; an empty
table gives no rows; other columns, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, read

MIN_SITES = 10
#: Sketches have 2**12 registers (a standard error of 1.6 %); within NEAR of the threshold lines are counted exactly.
LG_K, NEAR = 12, 0.1


WHITE = " \t\r\x0b\x0c"


def lines(docs: DataFrame) -> DataFrame:
    """One row per non-blank line, written: document key, site, position and two hashes of the line, 128 bits together."""
    split = docs.where(F.col("text").isNotNull()).select(
        "doc_id", F.col("source").alias("site"), F.xxhash64("text").alias("_t"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    line = F.btrim(F.col("line"), F.lit(WHITE))
    # A hash of several columns passes each one's on as the seed of the next: the constant comes
    # first, so that the second hash goes over the line with a seed of its own.
    return materialize(
        split.withColumn("line", line).where("line != ''")
        .select("doc_id", "_t", "site", "pos", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g")), "lines")


def boilerplate(rows: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(h, g, first): hashes of lines on at least ``min_sites`` sites, and their first place."""
    sketched = materialize(
        rows.groupBy("h", "g").agg(
            F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("site", LG_K).alias("sites"),
            F.min(F.struct("doc_id", "_t", "pos")).alias("first"))
        # Fewer rows than sites asked for: not boilerplate, whatever the sketch says.
        .where(F.col("n") >= min_sites)
        .select("h", "g", "first", F.hll_sketch_estimate("sites").alias("sites"))
        .where(F.col("sites") >= min_sites * (1 - NEAR)), "line-sketches")
    clear = sketched.where(F.col("sites") > min_sites * (1 + NEAR)).select("h", "g", "first")
    near = sketched.where(F.col("sites") <= min_sites * (1 + NEAR))
    exact = (
        rows.where("site is not null").join(near.select("h", "g"), ["h", "g"], "left_semi")
        .groupBy("h", "g", "site").agg(F.lit(1).alias("one"))
        .groupBy("h", "g").agg(F.count("one").alias("n")).where(F.col("n") >= min_sites))
    return materialize(clear.unionByName(near.join(exact, ["h", "g"]).select("h", "g", "first")), "boilerplate")


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """One row per row of ``docs``: that row (``own``), its new ``text``, ``n_lines`` and ``n_removed``."""
    rows = lines(docs)
    bad = boilerplate(rows, min_sites)
    place = F.struct("doc_id", "_t", "pos")
    gone = (
        rows.join(bad, ["h", "g"]).where(~place.eqNullSafe(F.col("first")))
        .groupBy(F.col("doc_id").alias("_id"), "_t").agg(F.collect_set("pos").alias("_gone")))
    # The row is kept as one struct, so that no name of its columns can clash.
    joined = docs.select(F.struct(*docs.columns).alias("own")).join(
        gone, F.col("own.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("own.text") == F.col("_t")), "left")
    old = F.col("own.text")
    parts = F.split(old, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_gone"))
    text = F.when(F.col("_gone").isNull(), old).otherwise(F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n"))
    return joined.select(
        "own", text.alias("text"), F.when(old.isNull(), 0).otherwise(F.size(parts)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_removed"))


def op7_line_spread(spark, sf_dir: str) -> DataFrame:
    out = remove_boilerplate(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("own.doc_id", "n_lines", "n_removed", "text")


def line_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines; documents of which nothing is left go."""
    out = remove_boilerplate(docs)
    empty = (F.col("n_removed") > 0) & (F.trim("text") == "")
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return out.where(~F.coalesce(empty, F.lit(False))).select(*[new.get(c, F.col(f"own.`{c}`")).alias(c) for c in docs.columns])


OP7_SQL = r"""
WITH parts AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
trimmed AS (SELECT *, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS line FROM parts),
bad AS (
  SELECT line, min(row(doc_id IS NOT NULL, doc_id, pos)) AS first FROM trimmed WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 10),
rebuilt AS (
  SELECT t.doc_id, count(*) AS n_lines, count(*) FILTER (b.line IS NOT NULL AND row(t.doc_id IS NOT NULL, t.doc_id, t.pos) <> b.first) AS n_removed,
         string_agg(raw, chr(10) ORDER BY pos) FILTER (b.line IS NULL OR row(t.doc_id IS NOT NULL, t.doc_id, t.pos) = b.first) AS text
  FROM trimmed t LEFT JOIN bad b ON t.line = b.line GROUP BY t.doc_id)
SELECT d.doc_id, coalesce(r.n_lines, 0) AS n_lines, coalesce(r.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(r.text, '') END AS text
FROM documents d LEFT JOIN rebuilt r ON d.doc_id IS NOT DISTINCT FROM r.doc_id
"""
