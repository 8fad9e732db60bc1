"""Quality classifier by importance resampling.

Two generative models over hashed words and word pairs (each once a text), one of the labelled
good documents (target), one of all documents (raw), give each document the log
of the ratio of its probabilities. Each model has two tables under independent
hashes, and a gram weighs what the weaker of its two buckets says: a frequent
clean gram that shares one bucket with a foul one weighs nothing. Gumbel noise from its id is added, and the k
documents with the largest sums are the sample: k draws without replacement,
with probability in proportion to the ratio.

Only buckets whose counts in the target differ from the raw share by more than
chance and by a fair factor have a weight; the raw share is scaled so that the
mass of undecided buckets weighs nothing. So a clean document of any length has
a ratio near one.

Texts that are null or empty hold no word and have ratio one. Repeated rows
have equal sums; all rows that tie with the k-th are kept. A null id draws its
noise as a value of its own. An empty table gives an empty result. Without
labelled rows every ratio is one. Other columns are carried untouched in a
struct, so names cannot clash.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import load, pieces, prepare, rolled, settled, word_hashes

#: Buckets of each of the two tables.
BITS = 20
BUCKETS = 1 << BITS
#: Labelled rows that the target model is fitted on, at most: those of least hash.
TARGET_ROWS = 20_000
#: Buckets count if so many good documents are expected to hold them, and the target
#: differs by so many standard deviations and by this log.
EXPECTED, SIGMAS, LEAST = 40.0, 5.0, 1.5
#: Log ratio down to which a document counts as one the target could have.
MARGIN = 3.0
SEED = 23
_SLICE = 2048
_STUTTER = 0x9E3779B97F


def _grams(texts):
    """Number of every word and word pair, and the place of its text.

    The lower and the upper ``BITS`` bits of a number are its buckets. A word
    five times in a row is one gram of its own, whatever the word.
    """
    h, bounds = word_hashes(texts)
    mask = np.uint64((1 << 2 * BITS) - 1)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = doc[:-1] == doc[1:]
    grams = np.concatenate([h & mask, (rolled(h, 2) & mask)[inside]]) if len(h) else h
    same = (h[:-1] == h[1:]) & inside
    row = same[:-3] & same[1:-2] & same[2:-1] & same[3:] if len(same) > 3 else same[:0]
    stutter = np.full(row.sum(), _STUTTER, np.int64)
    return np.concatenate([grams.astype(np.int64), stutter]), np.concatenate([doc, doc[:-1][inside], doc[: len(row)][row]])


def _sums(grams) -> np.ndarray:
    """Grams in each bucket of both tables, one table behind the other."""
    return np.concatenate([np.bincount(b, minlength=BUCKETS) for b in (grams & (BUCKETS - 1), grams >> BITS)]).astype(np.int32)


def gram_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents that hold each bucket, by table: of all, and of those marked ``good``.

    A gram counts once a document, else a few very long texts would pass for a
    habit of many. A task sends its counts once, in slices; ``2 * BUCKETS`` sums
    come to the driver at any input size.
    """

    def count(batches):
        raw, good = np.zeros(2 * BUCKETS, np.int32), np.zeros(2 * BUCKETS, np.int32)
        for batch in batches:
            for part in pieces(batch, "text"):
                grams, doc = _grams(part.text)
                once = np.unique(grams * len(part) + doc)
                raw += _sums(once // len(part))
                marked = part.good.to_numpy(bool)
                if marked.any():
                    good += _sums(once[marked[once % len(part)]] // len(part))
        if raw.any():
            for s in range(0, 2 * BUCKETS, _SLICE):
                yield pd.DataFrame({"slice": [s], "raw": [raw[s : s + _SLICE]], "good": [good[s : s + _SLICE]]})

    def add(part):
        return pd.DataFrame({"slice": [part["slice"].iloc[0]], **{
            k: [np.stack(part[k].to_list()).sum(0, dtype=np.int64)] for k in ("raw", "good")}})

    prepare(docs.sparkSession)
    # a thousand groups of one row a task: bounded, and equally many for each
    sent = docs.select("text", "good").mapInPandas(count, "slice int, raw array<int>, good array<int>")
    sums = sent.groupBy("slice").applyInPandas(add, "slice int, raw array<bigint>, good array<bigint>").toPandas()
    raw, good = np.zeros(2 * BUCKETS, np.int64), np.zeros(2 * BUCKETS, np.int64)
    for s, r, g in sums.itertuples(index=False):
        raw[s : s + _SLICE], good[s : s + _SLICE] = r, g
    return raw.reshape(2, -1), good.reshape(2, -1)


def weights(raw: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Log ratio of target and raw probability per bucket of a table; zero where chance could explain it."""
    if not good.sum():
        return np.zeros(len(raw), np.float32)
    expected = raw * (good.sum() / raw.sum())
    seen = expected > 25
    if seen.any():
        # the usual ratio is that of words which only clean texts hold
        order = np.argsort(ratio := good[seen] / expected[seen])
        mass = np.cumsum(expected[seen][order])
        expected = expected * ratio[order][np.searchsorted(mass, mass[-1] / 2)]
    log = np.log((good + 1.0) / (expected + 1.0))
    sure = (np.abs(good - expected) > SIGMAS * np.sqrt(expected + 1)) & (np.abs(log) > LEAST) & (expected > EXPECTED)
    return np.where(sure & (log < 0), log, 0.0).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TARGET_ROWS) -> np.ndarray:
    """Bucket weights of both tables: all documents against good labelled ones.

    At most ``rows`` labelled ids are taken, by least hash, and broadcast: eight
    bytes each. Everything is counted over all documents.
    """
    good = labels.filter("quality = 1 and toxic = 0 and doc_id is not null").select("doc_id").distinct()
    good = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").alias("good_id"))
    d = docs.join(F.broadcast(good), docs["doc_id"] == F.col("good_id"), "left")
    raw, good = gram_counts(d.select("text", F.col("good_id").isNotNull().alias("good")))
    return np.stack([weights(r, g) for r, g in zip(raw, good, strict=True)])


def scored(docs: DataFrame, model: np.ndarray, seed: int = SEED) -> DataFrame:
    """``doc`` (all columns), ``log_weight`` and ``sample_key`` = log weight + Gumbel noise."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def log_weight(text: pd.Series) -> pd.Series:
        table, out, frame = shared.value, [], pd.DataFrame({"text": text})
        for part in pieces(frame, "text"):
            grams, doc = _grams(part.text)
            out.append(np.bincount(doc, np.maximum(table[0][grams & (BUCKETS - 1)], table[1][grams >> BITS]), len(part)))
        return pd.Series(np.concatenate(out) if out else np.empty(0))

    u = (F.pmod(F.xxhash64(F.lit(seed), "doc.doc_id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    d = docs.select(F.struct("*").alias("doc")).withColumn("log_weight", log_weight("doc.text"))
    return d.withColumn("sample_key", F.col("log_weight") - F.log(-F.log(u)))


def cut_at(keys: DataFrame, k: int, bins: int = 4096) -> float:
    """The k-th largest ``sample_key``, found by counting in ever narrower bins.

    Each step brings ``bins`` counts to the driver and sorts nothing.
    """
    low, high = keys.agg(F.min("sample_key"), F.max("sample_key")).first()
    if low is None or k <= 0:
        return float("inf")
    above = 0
    while True:
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            return low
        at = F.least(F.floor((F.col("sample_key") - low) / width), F.lit(bins - 1))
        inside = keys.filter(F.col("sample_key").between(low, high))
        found = inside.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("sample_key").alias("least"), F.max("sample_key").alias("most"))
        for r in sorted(found.collect(), key=lambda r: -r.bin):
            if above + r.n > k:
                break
            above += r.n
            low_kept = r.least
        else:
            return low
        if above == k:
            return low_kept
        if (r.least, r.most) == (low, high) or r.least == r.most:
            return r.least
        low, high = r.least, r.most


def resample(docs: DataFrame, model: np.ndarray, k: int | None = None, seed: int = SEED) -> DataFrame:
    """All rows, scored, with ``selected``: whether the Gumbel top-k sample holds it.

    Without ``k`` the sample has as many rows as have a log ratio of at least
    ``-MARGIN``. Scores without texts are written once and counted from there.
    """
    slim = settled(scored(docs, model, seed).select("log_weight", "sample_key"), "sample-keys")
    if k is None:
        k = slim.filter(F.col("log_weight") >= -MARGIN).count()
    limit = cut_at(slim, k)
    return scored(docs, model, seed).withColumn("selected", F.col("sample_key") >= F.lit(limit))


def stage(spark, docs, folder):
    """The documents of the sample, in their own columns."""
    model = fit(docs, load(spark, folder, "labels"))
    return resample(docs, model).filter("selected").select("doc.*")


def op3_quality_classifier(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs, load(spark, folder, "labels"))
    return resample(docs, model).select(F.col("doc.doc_id").alias("doc_id"), "log_weight", "sample_key", "selected")
