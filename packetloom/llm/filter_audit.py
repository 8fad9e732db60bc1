"""Filter interaction audit: what each filter adds, for every order of filters.

Filters A to D judge a document by its text alone; E asks whether a smaller
doc_id holds the same text. E is a left-semi join: each row meets the smallest
id of its text, matched by hash and exact text. Texts are grouped by hash and
text, so copies are merged before the shuffle and each text is moved once; a
hash that only one text has stands for that text, and rows of a hash with
several texts are joined on the texts. The ids found are united with the
other failures, the bits of a document are or-ed together, and documents are
counted by part and combination of bits: at most 32 rows a part. All orders and
steps are read off these counts.

A null text is empty and fails A; a null lang is the part of the empty string. A row
with a null doc_id counts, never fails E and has no label. Repeated rows count
each; rows of one id and text with E's failure all have it. An id with several
labels is good (toxic) if one of them says so. An empty table gives no rows.
Only doc_id, text and lang are read, so other columns cannot clash.
"""

from itertools import permutations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import let, load, settled, words

#: Names of the filters; bit k of a combination is the k-th filter's failure.
FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``hash`` of the text, ``part`` and ``bits`` of A to D, with the number of such rows."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))

    def by_words(w):
        n, kinds = F.size(w).cast("long"), F.size(F.array_distinct(w)).cast("long")
        return F.when(n < 100, 1).otherwise(0) + F.when(100 * kinds < 80 * n, 2).otherwise(0)

    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long")
    shouted = F.when(100 * capitals > 10 * F.length("text").cast("long"), 4).otherwise(0)
    marked = F.when(F.col("text").rlike("[#$%&*|]"), 8).otherwise(0)
    bits = let(words(F.col("text")), by_words) + shouted + marked
    d = d.select("doc_id", F.xxhash64("text").alias("hash"), "part", bits.alias("bits"))
    return d.groupBy("doc_id", "hash", "part", "bits").agg(F.count(F.lit(1)).alias("n"))


def repeated(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The ``rows`` (``doc_id``, ``hash``, ...) whose text a smaller doc_id holds in ``docs``."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    smallest = F.min("doc_id").alias("smallest")
    owners = settled(texts.groupBy("hash", "text").agg(smallest).select("hash", "smallest"), "text-owners")
    of_hash = owners.groupBy("hash").agg(F.count(F.lit(1)).alias("texts"), F.min("smallest").alias("smallest"))

    def later(left, right, *same):
        on = [left[c] == right[c] for c in same]
        return left.join(right, [*on, right["smallest"] < left["doc_id"]], "left_semi")

    found = later(rows, of_hash.filter("texts = 1"), "hash")
    several = of_hash.filter("texts > 1").select("hash")
    if several.isEmpty():
        return found
    # one hash, several texts: the texts themselves decide
    shared = texts.join(several, "hash", "left_semi")
    ids = later(shared, shared.groupBy("hash", "text").agg(smallest), "hash", "text").select("doc_id", "hash").distinct()
    return found.unionByName(rows.join(ids, ["doc_id", "hash"], "left_semi"))


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good and toxic ones by ``part`` and ``bits`` of all failures."""
    rows = settled(judged(docs), "filter-failures")
    again = repeated(docs, rows.select("doc_id", "hash", "part").distinct())
    again = again.select("doc_id", "hash", "part", F.lit(REPEATED).alias("bits"), F.lit(0).cast("long").alias("n"))
    d = rows.unionByName(again).groupBy("doc_id", "hash", "part").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    named = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    d = d.join(named, d["doc_id"] == named["label_id"], "left")
    return d.groupBy("part", "bits").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("n_good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("n_toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step, from the counts of combinations."""
    fails = F.concat(*[F.when(F.col("bits").bitwiseAND(1 << k) != 0, x).otherwise("") for k, x in enumerate(FILTERS)])
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    d = combinations(docs, labels).withColumn("fails", fails)
    d = d.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(steps))
    d = d.withColumn("filter", F.expr("substring(filter_order, step, 1)")).withColumn("before", F.expr("substring(filter_order, 1, step - 1)"))
    here = F.contains("fails", "filter")
    gone = F.length(F.expr("translate(before, fails, '')")) < F.length("before")

    def total(which, count="n"):
        return F.sum(F.when(which, F.col(count)).otherwise(0))

    d = d.groupBy("part", "filter_order", "step", "filter").agg(
        total(~here & ~gone).alias("kept"), total(here & ~gone).alias("removed"), total(here & gone).alias("redundant"),
        total(F.col("fails") == F.col("filter")).alias("unique_fails"),
        total(here & ~gone, "n_good").alias("good_lost"), total(here & ~gone, "n_toxic").alias("toxic_lost"))
    return d.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))).drop("filter")


def op13_filter_audit(spark, folder):
    return audit(load(spark, folder, "documents"), load(spark, folder, "labels"))


ORACLE = r"""
with docs as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as body from documents),
split as (
  select *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') as ws,
    min(doc_id) over (partition by body) as smallest from docs),
named as (
  select doc_id as label_id, max(case when quality = 1 then 1 else 0 end) as good,
    max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by 1),
failed as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    case when len(ws) < 100 then 'A' else '' end
    || case when 100 * len(list_distinct(ws)) < 80 * len(ws) then 'B' else '' end
    || case when 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body) then 'C' else '' end
    || case when regexp_matches(body, '[#$%&*|]') then 'D' else '' end
    || case when smallest < doc_id then 'E' else '' end as fails
  from split left join named on doc_id = label_id),
counted as (
  select part, fails, count(*) as n, sum(good) as n_good, sum(toxic) as n_toxic from failed group by 1, 2),
names as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order
  from names a join names b on b.f <> a.f join names c on c.f not in (a.f, b.f)
    join names d on d.f not in (a.f, b.f, c.f) join names e on e.f not in (a.f, b.f, c.f, d.f)),
steps as (
  select filter_order, step::int as step, filter_order[step] as f, left(filter_order, step::int - 1) as earlier
  from orders cross join (select unnest([1, 2, 3, 4, 5]) as step)),
marks as (
  select part, filter_order, step, f, n, n_good, n_toxic, fails, contains(fails, f) as here,
    translate(earlier, fails, '') <> earlier as gone
  from counted cross join steps),
sums as (
  select part, filter_order, step, f,
    sum(case when not here and not gone then n else 0 end)::bigint as kept,
    sum(case when here and not gone then n else 0 end)::bigint as removed,
    sum(case when here and gone then n else 0 end)::bigint as redundant,
    sum(case when fails = f then n else 0 end)::bigint as unique_fails,
    sum(case when here and not gone then n_good else 0 end)::bigint as good_lost,
    sum(case when here and not gone then n_toxic else 0 end)::bigint as toxic_lost
  from marks group by 1, 2, 3, 4)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, f))::bigint as shapley
from sums
"""
