"""Language ID by a bidirectional gated recurrent network over bytes.

A text is lower-cased and cut at blanks, tabs and line ends, and a longer run
after every ``LONGEST`` bytes; on each such segment the network starts anew. One
gated layer reads the segment's bytes forwards, one backwards, and every byte
gets a probability for each language from both states. A document's probability
is the normalised geometric mean over all of its bytes. Equal segments have
equal labels, so a task reads most of them once and counts them.

The network is fitted in numpy by backpropagation through time (Adam, cross
entropy at every byte). Only texts and languages of documents in the training
folds are seen, of these a bounded sample: ``SAMPLE_DOCS`` documents of each
language by least hash of the id, of their segments a draw weighted by count, at
most ``SAMPLE_SEGMENTS`` over all languages, in equal shares. Counting is Spark's; what comes to the
driver is the sample, some megabytes at any size of the input.

A null text, and one without a letter, is ``und`` with score 0; so is every text
if nothing can be learned. Ties go to the first language in sorted order. A null
doc_id is no training row and not held out. Repeated rows have equal results. An
empty table gives an empty result. Documents of any length are read in blocks.
Other columns are carried untouched in a struct, so names cannot clash.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import GAP, load, prepare

#: Folds of the ids, and the one that is held out.
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
#: Bounds of the sample that the network is fitted on.
SAMPLE_DOCS, SAMPLE_SEGMENTS = 300, 16_000
#: Units of a direction, bytes of a segment, passes over the sample.
UNITS, LONGEST, EPOCHS = 16, 24, 14
MINIBATCH, RATE, SEED = 256, 0.01, 11
#: Segments whose labels a task remembers.
CACHE = 1 << 18
_BLOCK = 1 << 20
_SPACE = re.compile(r"[ \t-\r]")


@dataclass
class Network:
    """``tables``: input weights and bias per byte; ``loops``: recurrent weights; by direction."""

    languages: list
    tables: list
    loops: list
    offsets: list
    out: np.ndarray
    bias: np.ndarray

    def weights(self):
        return [*self.tables, *self.loops, *self.offsets, self.out, self.bias]


def fresh(languages: list, rng) -> Network:
    def some(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    h = UNITS
    return Network(
        languages,
        [(rng.standard_normal((256, 3 * h)) * 0.3).astype(np.float32) for _ in range(2)],
        [some(h, 3 * h) for _ in range(2)],
        [np.zeros(h, np.float32) for _ in range(2)],
        some(2 * h, len(languages)), np.zeros(len(languages), np.float32))


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _states(net, way, data, steps=None):
    """States of one direction, (bytes, segments, units), each after its byte; fills ``steps`` for the way back."""
    table, loop, offset, h = net.tables[way], net.loops[way], net.offsets[way], UNITS
    n, length = data.shape
    out, state = np.empty((length, n, h), np.float32), np.zeros((n, h), np.float32)
    for t in range(length) if way == 0 else range(length - 1, -1, -1):
        x, u = table[data[:, t]], state @ loop
        gates = _sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
        keep, reset = gates[:, :h], gates[:, h:]
        inner = u[:, 2 * h :] + offset
        new = np.tanh(x[:, 2 * h :] + reset * inner)
        if steps is not None:
            steps.append((t, state, keep, reset, inner, new))
        state = new + keep * (state - new)
        out[t] = state
    return out


def _log_probabilities(net, data, steps=(None, None)):
    """Of each byte's languages, (bytes, segments, languages); and the joined states."""
    ways = [_states(net, w, data, steps[w]) for w in range(2)]
    joined = np.concatenate(ways, axis=2)
    scores = joined @ net.out + net.bias
    scores -= scores.max(2, keepdims=True)
    return scores - np.log(np.exp(scores).sum(2, keepdims=True)), joined


def gradients(net: Network, data: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, list]:
    """Loss summed over all bytes, and its gradient by all weights: backpropagation through time."""
    h, (n, length) = UNITS, data.shape
    steps = ([], [])
    log, joined = _log_probabilities(net, data, steps)
    each = np.arange(n)
    loss = -float((log[:, each, label] * weight).sum())
    d_scores = np.exp(log)
    d_scores[:, each, label] -= 1
    d_scores *= weight[None, :, None]
    flat = d_scores.reshape(-1, d_scores.shape[2])
    d_out, d_bias = joined.reshape(-1, 2 * h).T @ flat, flat.sum(0)
    d_joined = d_scores @ net.out.T
    d_tables, d_loops, d_offsets = [], [], []
    for way in range(2):
        loop = net.loops[way]
        d_table, d_loop, d_offset = np.zeros_like(net.tables[way]), np.zeros_like(loop), np.zeros(h, np.float32)
        back = np.zeros((n, h), np.float32)
        for t, before, keep, reset, inner, new in reversed(steps[way]):
            d = back + d_joined[t, :, way * h : (way + 1) * h]
            d_new = d * (1 - keep) * (1 - new * new)
            d_keep = d * (before - new) * keep * (1 - keep)
            d_reset = d_new * inner * reset * (1 - reset)
            d_inner = d_new * reset
            d_x = np.concatenate([d_keep, d_reset, d_new], 1)
            d_u = np.concatenate([d_keep, d_reset, d_inner], 1)
            np.add.at(d_table, data[:, t], d_x)
            d_loop += before.T @ d_u
            d_offset += d_inner.sum(0)
            back = d * keep + d_u @ loop.T
        d_tables.append(d_table)
        d_loops.append(d_loop)
        d_offsets.append(d_offset)
    return loss, [*d_tables, *d_loops, *d_offsets, d_out, d_bias]


def _by_length(segments):
    """Places of the segments by length, with their bytes as a matrix."""
    lengths = np.fromiter(map(len, segments), np.int64, len(segments))
    order = np.argsort(lengths, kind="stable")
    for length in np.unique(lengths):
        at = order[np.searchsorted(lengths[order], length) : np.searchsorted(lengths[order], length, "right")]
        joined = b"".join(segments[i] for i in at)
        yield at, np.frombuffer(joined, np.uint8).reshape(len(at), length)


def fit(sample: pd.DataFrame, epochs: int = EPOCHS, seed: int = SEED) -> Network | None:
    """Network fitted on rows of ``lang``, ``segment`` (bytes) and ``n``, as often as it was seen."""
    if not len(sample):
        return None
    sample = sample.sort_values(["lang", "segment"], kind="stable").reset_index(drop=True)
    languages = sorted(sample.lang.unique())
    rng = np.random.default_rng(seed)
    net = fresh(languages, rng)
    label = np.searchsorted(languages, sample.lang)
    weight = np.sqrt(sample.n.to_numpy(np.float64))
    weight = (weight / pd.Series(weight).groupby(label).transform("mean").to_numpy()).astype(np.float32)
    groups = list(_by_length(sample.segment.to_list()))
    weights = net.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step, steps = 0, epochs * sum(-(-len(at) // MINIBATCH) for at, _ in groups)
    for _ in range(epochs):
        parts = []
        for at, data in groups:
            mixed = rng.permutation(len(at))
            parts += [(at[p], data[p]) for p in np.array_split(mixed, -(-len(at) // MINIBATCH))]
        for k in rng.permutation(len(parts)):
            at, data = parts[k]
            _, slopes = gradients(net, data, label[at], weight[at])
            step += 1
            rate = RATE * (1 - step / (steps + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for w, g, a, b in zip(weights, slopes, first, second, strict=True):
                g = g / data.size
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= (rate * a / (np.sqrt(b) + 1e-8)).astype(np.float32)
    return net


def blocks(text: str):
    """The text in blocks that end at a blank, or after twice ``_BLOCK`` characters without one."""
    start = 0
    while start < len(text):
        end = start + _BLOCK
        if end < len(text):
            gap = _SPACE.search(text, end, end + _BLOCK)
            end = gap.start() if gap else min(end + _BLOCK, len(text))
        yield text[start:end]
        start = end


def segments(text: str) -> list:
    """Bytes of all segments of a text, in order."""
    runs = text.lower().encode().split()
    if max(map(len, runs), default=0) <= LONGEST:
        return runs
    return [run[i : i + LONGEST] for run in runs for i in range(0, len(run), LONGEST)]


def label_bytes(net: Network, segs: list) -> tuple[np.ndarray, np.ndarray]:
    """Of each segment: sums of its bytes' log probabilities, and its bytes by their likeliest language."""
    k = len(net.languages)
    logs, counts = np.zeros((len(segs), k)), np.zeros((len(segs), k), np.int64)
    for at, data in _by_length(segs):
        for i in range(0, len(at), 4096):
            log, _ = _log_probabilities(net, data[i : i + 4096])
            logs[at[i : i + 4096]] = log.sum(0)
            best = log.argmax(2)
            for j in range(k):
                counts[at[i : i + 4096], j] = (best == j).sum(0)
    return logs, counts


class Reader:
    """Reads texts with a network; remembers the labels of up to ``CACHE`` segments."""

    def __init__(self, net: Network):
        self.net, k = net, len(net.languages)
        self.places, self.logs, self.counts = {}, np.zeros((CACHE, k)), np.zeros((CACHE, k), np.int64)

    def labels(self, kinds: list) -> tuple[np.ndarray, np.ndarray]:
        """As ``label_bytes``, of different segments."""
        place = np.fromiter((self.places.get(x, -1) for x in kinds), np.int64, len(kinds))
        new = np.flatnonzero(place < 0)
        log, count = self.logs[place], self.counts[place]
        if len(new):
            log[new], count[new] = label_bytes(self.net, [kinds[i] for i in new])
            new = new[: CACHE - len(self.places)]
            at = len(self.places) + np.arange(len(new))
            self.logs[at], self.counts[at] = log[new], count[new]
            self.places.update(zip((kinds[i] for i in new), at, strict=True))
        return log, count

    def read(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Of each text: probabilities of the languages, and its bytes labelled with each."""
        k, held, doc, size, texts = len(self.net.languages), [], [], 0, list(texts)
        logs, counts = np.zeros((len(texts), k)), np.zeros((len(texts), k))

        def take():
            code, kinds = pd.factorize(np.array(held, object))
            of = np.repeat(*np.array(doc).T)
            log, count = self.labels(list(kinds))
            for j in range(k):
                logs[:, j] += np.bincount(of, log[code, j], len(texts))
                counts[:, j] += np.bincount(of, count[code, j], len(texts))

        for i, text in enumerate(texts):
            for block in blocks(text or ""):
                found = segments(block)
                held += found
                doc.append((i, len(found)))
                size += len(block)
                if size >= _BLOCK:
                    take()
                    held, doc, size = [], [], 0
        if held:
            take()
        mean = logs / np.maximum(counts.sum(1, keepdims=True), 1)
        share = np.exp(mean - mean.max(1, keepdims=True))
        return share / share.sum(1, keepdims=True), counts.astype(np.int64)


def spans(net: Network, text: str) -> list:
    """Runs of equally labelled bytes of the lower-cased text: start, end and language."""
    out, at, raw = [], 0, text.lower().encode()
    for seg in segments(text):
        at = raw.index(seg, at)
        log, _ = _log_probabilities(net, np.frombuffer(seg, np.uint8)[None, :])
        for k, best in enumerate(log[:, 0].argmax(1)):
            name = net.languages[best]
            if out and out[-1][1] == at + k and out[-1][2] == name:
                out[-1][1] += 1
            else:
                out.append([at + k, at + k + 1, name])
        at += len(seg)
    return [tuple(x) for x in out]


def fold(doc_id):
    return F.crc32(doc_id.cast("string")) % FOLDS


def sampled(docs: DataFrame) -> DataFrame:
    """``lang``, ``segment`` and count ``n``: the bounded sample of the training folds.

    The least hashes of each language are found with partial limits in every
    task, so a hot language sends no more rows than the others.
    """
    d = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT)).select("doc_id", "lang", "text")
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id", F.xxhash64("text"))
    d = d.withColumn("place", F.row_number().over(by_hash)).filter(F.col("place") <= SAMPLE_DOCS)
    runs = d.select("lang", F.explode(F.split(F.lower("text"), GAP)).alias("run")).filter("run <> ''")
    starts = F.sequence(F.lit(1), F.octet_length("run"), F.lit(LONGEST))
    d = runs.select("lang", F.explode(F.transform(starts, lambda s: F.substring(F.col("run").cast("binary"), s, F.lit(LONGEST)))).alias("segment"))
    d = d.groupBy("lang", "segment").agg(F.count(F.lit(1)).alias("n"))
    # least exponential arrival times at rate n: a draw weighted by count
    u = (F.pmod(F.xxhash64(F.lit(SEED), "segment", "lang"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    d = d.withColumn("arrival", -F.log(u) / F.col("n"))
    mine = Window.partitionBy("lang").orderBy("arrival", "segment")
    d = d.withColumn("place", F.row_number().over(mine)).filter(F.col("place") <= SAMPLE_SEGMENTS)
    return d.orderBy("place", "arrival", "lang", "segment").limit(SAMPLE_SEGMENTS).select("lang", "segment", "n")


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """``doc`` (all columns), ``lang_pred``, ``score``, and by language the ``probabilities`` and ``labelled`` bytes."""
    spark = docs.sparkSession
    prepare(spark)
    d = docs.select(F.struct("*").alias("doc"))
    none = {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "probabilities": F.lit(None).cast("map<string,double>"), "labelled": F.lit(None).cast("map<string,bigint>")}
    if net is None:
        return d.withColumns(none)
    shared = spark.sparkContext.broadcast(net)

    @F.pandas_udf("probabilities array<double>, labelled array<bigint>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value)
        for text in batches:
            share, counts = reader.read(text)
            yield pd.DataFrame({"probabilities": list(share), "labelled": list(counts)})

    names = F.array(*[F.lit(x) for x in net.languages])
    d = d.withColumn("read", read(F.coalesce("doc.text", F.lit(""))))
    known = F.coalesce(F.col("doc.text").rlike(r"\p{L}"), F.lit(False))
    best = F.array_max("read.probabilities")
    found = {
        "lang_pred": F.element_at(names, F.array_position("read.probabilities", best).cast("int")), "score": best,
        "probabilities": F.map_from_arrays(names, "read.probabilities"), "labelled": F.map_from_arrays(names, "read.labelled")}
    return d.withColumns({name: F.when(known, c).otherwise(none[name]) for name, c in found.items()}).drop("read")


def op11_language_id(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "text", "lang")
    net = fit(sampled(docs).toPandas())
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out")
    d = identify(docs.select("doc_id", "text", held_out), net)
    return d.select("doc.doc_id", "doc.held_out", "lang_pred", "score")
