"""Sources mixed to target weights by Poisson replication.

Every document gets a uniform number from its id and a seed, and by it a count
from the Poisson distribution whose mean is the repetition rate of its source.
A rate above ``PART`` is dealt over equal parts of at most that, each with a
number of its own; the sum of their counts has the same distribution, exactly.
It is repeated that often, and the copies are shuffled over all partitions.

A null source is a source of its own. Sources without a weight get none; without
weights all are equal. The same id draws the same count wherever it stands, so
repeated rows repeat alike. A null id draws as the text ``null`` would. Texts are
carried unread. An empty table gives an empty result.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import load

SEED = 17
#: Greatest rate inverted at once: its first term, exp(-rate), is still far above the least double.
PART = 500


def uniform(column, seed, part):
    """In (0, 1), from 52 bits of a digest of the seed, the value and the number of the part."""
    of = F.when(part > 1, F.concat(F.lit("/"), part.cast("string"))).otherwise("")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit("null")), of))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def rates(docs: DataFrame, source_col: str = "source", weights: DataFrame | None = None, total: int | None = None) -> DataFrame:
    """Mean repetitions of each source: its share of the target over its rows."""
    counted = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n_rows"))
    if weights is not None:
        w = weights.select(F.col("source").alias("w_source"), F.col("weight").cast("double").alias("weight"))
        counted = counted.join(w, F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source")
        counted = counted.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    else:
        counted = counted.withColumn("weight", F.lit(1.0))
    sums = counted.agg(F.sum("weight").alias("weights"), F.sum("n_rows").alias("rows")).first()
    size = float(total if total is not None else sums.rows or 0)
    share = F.col("weight") / F.lit(float(sums.weights or 1.0))
    return counted.withColumn("rate", share * F.lit(size) / F.col("n_rows"))


def poisson(u, rate):
    """Least count whose cumulated probability is above u, for a rate of at most ``PART``.

    Terms are added until they no longer change the sum of a double.
    """
    steps = F.sequence(F.lit(1), F.ceil(rate + 10 * F.sqrt(rate) + 40).cast("int"))
    start = F.struct(F.exp(-rate).alias("term"), F.exp(-rate).alias("sum"), F.lit(0).alias("n"))

    def step(a, k):
        term = a["term"] * rate / k
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"), F.when(a["sum"] <= u, k).otherwise(a["n"]).alias("n"))

    return F.aggregate(steps, start, step)["n"]


def count(column, rate, seed):
    """Poisson count of a value: the sum over its parts. Its work is in proportion to the copies."""
    parts = F.greatest(F.ceil(rate / PART), F.lit(1)).cast("int")
    numbers = F.transform(F.sequence(F.lit(1), parts), lambda k: uniform(column, seed, k))
    drawn = F.aggregate(numbers, F.lit(0), lambda n, u: n + poisson(u, rate / parts))
    return F.when(rate <= 0, 0).otherwise(drawn)


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", weights: DataFrame | None = None,
        total: int | None = None, seed: int = SEED) -> DataFrame:
    """All columns of ``docs`` in ``doc``, with ``copy`` (from 1), ``copies``, ``rate`` and ``shuffle_key``.

    The sources' rates are joined without a hint: few sources are broadcast,
    very many are sorted, and a hot one is split by adaptive execution.
    """
    rate = rates(docs, source_col, weights, total).select(F.col("source").alias("r_source"), "rate")
    d = docs.select(F.struct("*").alias("doc"))
    d = d.join(rate, F.col(f"doc.`{source_col}`").eqNullSafe(F.col("r_source")))
    d = d.select("doc", "rate", count(F.col(f"doc.`{id_col}`"), F.col("rate"), seed).alias("copies"))
    d = d.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    d = d.withColumn("shuffle_key", F.xxhash64(F.lit(seed), F.col(f"doc.`{id_col}`"), "copy"))
    # dealt by the key's high part and sorted by the whole of it: a random order
    # without the sampling pass of a range sort
    spread = F.xxhash64("shuffle_key")
    return d.repartition(spread).sortWithinPartitions("shuffle_key")


def op9_mixing(spark, folder):
    return mix(load(spark, folder, "documents")).select("doc.*", "rate", "copies", "copy")
