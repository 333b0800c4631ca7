"""URL filter: rules first, then a character language-model ratio.

URLs that a rule decides teach two variable-order Markov models, one of allowed
and one of blocked URLs, over the characters as they stand.  A context of up to
``ORDER`` characters is used as far as it was seen; Witten-Bell smoothing mixes every
order with the shorter ones, down to a uniform distribution over the characters met.
An undecided URL gets the mean of log p(allow) - log p(block) over its characters;
the cut between the verdicts lies where it parts the two classes on a fifth of the
decided URLs, which the models have not seen.

The models are tables of counted grams (a character with the ``ORDER`` before it),
which grow with the URLs.  Log ratios are computed for the distinct grams of the URLs to
score, order by order, by joins of counts; the URLs' grams then meet them in a join.
Grams that stand for more than one in ``HOT`` of all are at most ``HOT`` rows, so
these are broadcast, and no key of the join is on more rows than that.  All work is
in built-in functions.

Defined results: a NULL url, or one without ``://``, has an empty host and path,
no rule and a score of 0; an empty tail scores 0; a very long url is read whole, in
time linear in its length; where the rules teach only one class or none the cut is 0
and a missing model is uniform; a score at the cut is allowed; repeated rows stay
repeated and teach as often; an empty table gives no rows; other columns of the
input, whatever their names, are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_key, materialize, read

RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)
#: Characters of context at most, and what stands before the first character.
ORDER, START = 5, "\x02"
#: Grams on more than one in HOT of all places are joined by broadcast; they are at most HOT.
HOT = 4096
#: Log ratios are added up as whole multiples of 2**-SCORE_BITS, so that scores do not depend on the order of the sum.
SCORE_BITS = 40
#: One in so many decided URLs calibrates the cut; the others are counted.
FOLDS, SEED = 5, 3


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; NULL if none fits."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        own, slash, rest = rule.partition("/")
        fits = F.endswith(F.concat(F.lit("."), host), F.lit("." + own)) & F.startswith(path, F.lit(slash + rest))
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def grams_of(url: Column) -> Column:
    """For each character after ``://``, that character with the ORDER before it.

    The shifted arrays are made outside the lambda, so the work is linear in the url.
    """
    tail = F.coalesce(F.regexp_extract(url, r"(?s)://(.*)", 1), F.lit(""))
    chars = F.filter(F.split(tail, ""), lambda c: c != "")
    shifted = [F.concat(F.array_repeat(F.lit(START), k), chars).alias(f"c{k}") for k in range(ORDER, -1, -1)]
    zipped = F.slice(F.arrays_zip(*shifted), 1, F.size(chars))
    return F.transform(zipped, lambda z: F.concat(*[z[f"c{k}"] for k in range(ORDER, -1, -1)]))


def log_ratios(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """(gram, ratio), written: log p(allow) - log p(block) of the distinct grams ``asked``, from counts (gram, allow, block)."""
    letters = materialize(counts.select(F.right("gram", F.lit(1)).alias("c")).distinct().agg(
        (F.lit(1.0) / (F.count(F.lit(1)) + 1)).alias("p")), "url-letters").select("p").scalar()
    lower = None
    for order in range(ORDER + 1):
        seen = counts.groupBy(F.right("gram", F.lit(order + 1)).alias("_gram")).agg(
            F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        context = seen.groupBy(F.left("_gram", F.lit(order)).alias("_context")).agg(
            *[F.sum(c).alias(f"_n_{c}") for c in ("allow", "block")],
            *[F.count_if(F.col(c) > 0).alias(f"_t_{c}") for c in ("allow", "block")])
        cells = asked.select(F.right("gram", F.lit(order + 1)).alias("gram")).distinct()
        both = cells.join(seen, F.col("gram") == F.col("_gram"), "left").join(
            context, F.left("gram", F.lit(order)) == F.col("_context"), "left")
        if lower is not None:
            both = both.join(lower.withColumnRenamed("gram", "_low"), F.right("gram", F.lit(order)) == F.col("_low"), "left")

        def mixed(c: str) -> Column:
            below = F.col(f"p_{c}") if lower is not None else letters
            n, t = F.coalesce(f"_n_{c}", F.lit(0)), F.coalesce(f"_t_{c}", F.lit(0))
            return F.when(n > 0, (F.coalesce(c, F.lit(0)) + t * below) / (n + t)).otherwise(below)

        lower = materialize(
            both.select("gram", mixed("allow").alias("_a"), mixed("block").alias("_b"))
            .select("gram", F.col("_a").alias("p_allow"), F.col("_b").alias("p_block")), f"url-order-{order}")
    # An order's grams have order + 1 characters, so the last ones are whole.
    units = F.round((F.log("p_allow") - F.log("p_block")) * 2.0**SCORE_BITS).cast("bigint")
    return lower.select("gram", units.alias("units"))


def scored(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """(row, score) of ``urls`` (row, url) that have characters to score."""
    each = materialize(urls.select("row", F.explode(grams_of(F.col("url"))).alias("gram")), "url-places")
    asked = materialize(each.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "url-asked")
    total = asked.agg(F.sum("n")).select(F.col("sum(n)")).scalar()
    ratios = materialize(
        log_ratios(counts, asked).join(asked.withColumnRenamed("gram", "_gram"), F.col("gram") == F.col("_gram"))
        .select(F.col("gram").alias("_gram"), "units", (F.col("n") * HOT > total).alias("hot")), "url-ratios")
    same = F.col("gram") == F.col("_gram")
    often = each.join(F.broadcast(ratios.where("hot").select("_gram", "units")), same, "left")
    seldom = often.where("_gram is null").select("row", "gram").join(ratios.where("not hot").select("_gram", "units"), same)
    known = often.where("_gram is not null").select("row", "units").unionByName(seldom.select("row", "units"))
    return known.groupBy("row").agg((F.sum("units") / F.count("units") / 2.0**SCORE_BITS).alias("score"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score (of undecided URLs)."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn(
        "_rule", rule_of(F.col("host"), F.col("path"), rules))
    fold = F.when(F.col("_rule").isNotNull(), hash_key(F.lit(SEED), F.col("url")) % FOLDS)
    urls = materialize(parsed.select(
        "page_id", "url", "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("verdict"),
        fold.alias("fold"), F.monotonically_increasing_id().alias("row")), "urls")
    counts = materialize(
        urls.where("fold <> 0").select("verdict", F.explode(grams_of(F.col("url"))).alias("gram")).groupBy("gram").agg(
            F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block")),
        "url-grams")
    asked = urls.where("fold = 0 or fold is null").select("row", "url")
    scores = materialize(scored(asked, counts), "url-scores").withColumnRenamed("row", "_row")
    with_score = urls.join(scores, F.col("row") == F.col("_row"), "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    held = with_score.where("fold = 0").groupBy("verdict").agg(F.avg("score").alias("m"), F.stddev_pop("score").alias("s"))
    a, b = (F.max(F.when(F.col("verdict") == v, F.struct("m", "s"))) for v in ("allow", "block"))
    spread = a["s"] + b["s"]
    cut = F.when(spread > 0, (a["m"] * b["s"] + b["m"] * a["s"]) / spread).otherwise((a["m"] + b["m"]) / 2)
    # The cut is one row; written, it is computed once.
    cut = materialize(held.agg(F.coalesce(cut, F.lit(0.0)).alias("cut")), "url-cut").select("cut").scalar()
    opened = F.col("verdict").isNull()
    return with_score.select(
        "page_id", "host", "path", "rule",
        F.when(opened, F.when(F.col("score") >= cut, "allow").otherwise("block")).otherwise(F.col("verdict")).alias("verdict"),
        F.when(opened, F.col("score")).alias("score"))


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages")).drop("score")


def _order_sql(k: int) -> str:
    """The mixture of one order with the order below, for the grams that are asked for."""
    low = "l.p" if k else "(SELECT p FROM letters)"
    below = f"LEFT JOIN p{k - 1} l ON l.verdict = c.verdict AND l.g = right(a.g, {k})" if k else ""
    return f"""
n{k} AS (SELECT verdict, right(gram, {k + 1}) AS g, sum(n) AS n FROM counted GROUP BY ALL),
h{k} AS (SELECT verdict, left(g, {k}) AS h, sum(n) AS n, count(*) AS t FROM n{k} GROUP BY ALL),
a{k} AS (SELECT DISTINCT right(gram, {k + 1}) AS g FROM asked),
p{k} AS (
  SELECT a.g, c.verdict, CASE WHEN h.n > 0 THEN (coalesce(n.n, 0) + h.t * {low}) / (h.n + h.t) ELSE {low} END AS p
  FROM a{k} a CROSS JOIN classes c LEFT JOIN h{k} h ON h.verdict = c.verdict AND h.h = left(a.g, {k})
  LEFT JOIN n{k} n ON n.verdict = c.verdict AND n.g = a.g {below}),"""


OP3_SQL = r"""
WITH parsed AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(verdict, rule) AS (VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'), ('allow', 'com/fr/'), ('block', 'com/de/')),
split_rules AS (SELECT *, string_split(rule, '/')[1] AS own, substr(rule, instr(rule, '/')) AS rest FROM rules),
ruled AS (
  SELECT p.*, row_number() OVER () AS id,
         (SELECT arg_max({'rule': rule, 'verdict': verdict}, length(rule)) FROM split_rules
          WHERE ends_with('.' || p.host, '.' || own) AND starts_with(p.path, rest)) AS r FROM parsed p),
marked AS (
  SELECT *, CASE WHEN r IS NOT NULL THEN ('0x' || substr(md5('3:' || url), 1, 15))::BIGINT % 5 END AS fold,
         coalesce(regexp_extract(url, '://(.*)', 1, 's'), '') AS tail FROM ruled),
grams AS (
  SELECT id, r.verdict AS verdict, fold, substr(repeat(chr(2), 5) || tail, unnest(range(1, length(tail) + 1)), 6) AS gram FROM marked),
counted AS (SELECT verdict, gram, count(*) AS n FROM grams WHERE fold <> 0 AND verdict IS NOT NULL GROUP BY ALL),
classes(verdict) AS (VALUES ('allow'), ('block')),
letters AS (SELECT 1::DOUBLE / (count(DISTINCT right(gram, 1)) + 1) AS p FROM counted),
asked AS (SELECT DISTINCT gram FROM grams WHERE fold IS NULL OR fold = 0),
""" + "".join(_order_sql(k) for k in range(ORDER + 1)) + r"""
ratios AS (SELECT g AS gram, round(sum(CASE verdict WHEN 'allow' THEN ln(p) ELSE -ln(p) END) * power(2, 40))::BIGINT AS units FROM p5 GROUP BY g),
scores AS (SELECT id, sum(units)::DOUBLE / count(*) / power(2, 40) AS score FROM grams JOIN ratios USING (gram) GROUP BY id),
judged AS (SELECT u.*, coalesce(s.score, 0) AS score FROM marked u LEFT JOIN scores s USING (id)),
held AS (
  SELECT avg(score) FILTER (r.verdict = 'allow') AS ma, stddev_pop(score) FILTER (r.verdict = 'allow') AS sa,
         avg(score) FILTER (r.verdict = 'block') AS mb, stddev_pop(score) FILTER (r.verdict = 'block') AS sb FROM judged WHERE fold = 0),
cut AS (SELECT coalesce(CASE WHEN sa + sb > 0 THEN (ma * sb + mb * sa) / (sa + sb) ELSE (ma + mb) / 2 END, 0) AS cut FROM held)
SELECT page_id, host, path, r.rule AS rule,
       coalesce(r.verdict, CASE WHEN score >= (SELECT cut FROM cut) THEN 'allow' ELSE 'block' END) AS verdict FROM judged
"""
