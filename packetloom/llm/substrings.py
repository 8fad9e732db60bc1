"""Removal of passages of fifty or more words that an earlier document holds.

Suffix automata of reference shards give, for every word of a streamed passage,
the longest run ending there that the reference holds; runs of at least the
threshold are removed. The reference is what repeats at all: for every repeated
window, the place in the document of least id. It and the passages to be
streamed are found by hashes first, in two steps:

1. of every window one word 25-gram, that of least hash, is its anchor; anchors
   that stand in one text only rule out most of the corpus;
2. windows around the remaining anchors are hashed, and the least and the
   largest document of each is found by a partial and a final aggregate.

A passage goes to the shard of the document that owns its windows. An automaton
of the whole corpus could be neither broadcast nor streamed by every document
in linear time, so an automaton is built where its shard's passages are: in the
task of the shard and one of its ``SALTS`` parts. A passage in a third of all
documents so has one owner and meets its automaton in many tasks.

Equal texts are judged once. Nulls and empty texts have no word. A row without
an id is neither earlier nor later than others and keeps its words. Rows that
repeat an id do not remove each other's words. An empty table gives an empty
result. Only the id and text columns are read, so other columns cannot clash.
"""

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import WORD, load, pieces, prepare, rolled, settled, word_hashes, words

WINDOW = 50
ANCHOR = 25
SALTS = 4
#: Words of reference that a shard holds on average.
SHARD_WORDS = 50_000
_NEAR = WINDOW - ANCHOR
_WORD = re.compile(WORD)


class Automaton:
    """Suffix automaton of word sequences.

    States lie in flat lists; moves are kept in one dictionary keyed by state
    and word. Sequences are added one after another, each from the start, so no
    match runs over the end of one.
    """

    def __init__(self):
        self.length, self.link, self.moves = [0], [-1], [{}]
        self.last = 0

    def add(self, sequence):
        length, link, moves = self.length, self.link, self.moves
        last = 0
        for word in sequence:
            known = moves[last].get(word)
            if known is not None and length[known] == length[last] + 1:
                last = known
                continue
            new, state = len(length), last
            if known is None:
                length.append(length[last] + 1)
                link.append(0)
                moves.append({})
                while state != -1 and word not in moves[state]:
                    moves[state][word] = new
                    state = link[state]
                if state == -1:
                    last = new
                    continue
                known = moves[state][word]
                if length[known] == length[state] + 1:
                    link[new] = known
                    last = new
                    continue
                twin = self._twin(state, word, known)
                link[new] = twin
                last = new
            else:
                last = self._twin(state, word, known)

    def _twin(self, state, word, known):
        """A copy of ``known`` that holds the shorter of its runs."""
        twin = len(self.length)
        self.length.append(self.length[state] + 1)
        self.link.append(self.link[known])
        self.moves.append(dict(self.moves[known]))
        self.link[known] = twin
        while state != -1 and self.moves[state].get(word) == known:
            self.moves[state][word] = twin
            state = self.link[state]
        return twin

    def spans(self, sequence, least):
        """Maximal spans ``(start, end)`` covered by runs of at least ``least`` words of the reference."""
        state, run, out = 0, 0, []
        for i, word in enumerate(sequence):
            while state and word not in self.moves[state]:
                state = self.link[state]
                run = self.length[state]
            if word in self.moves[state]:
                state = self.moves[state][word]
                run += 1
            if run >= least:
                start = i + 1 - run
                if out and start <= out[-1][1]:
                    out[-1] = (min(start, out[-1][0]), i + 1)
                else:
                    out.append((start, i + 1))
        return out


def anchors(docs: DataFrame) -> DataFrame:
    """``anchor``, ``digest`` and ``place`` of the anchors of each text."""

    def find(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                h, bounds = word_hashes(part.text)
                grams = rolled(h, ANCHOR)
                if len(grams) <= _NEAR:
                    continue
                # least gram of each window, by doubling: 26 = 16 + 16 - 6
                low = grams
                for step in (1, 2, 4, 8):
                    low = np.minimum(low[:-step], low[step:])
                low = np.minimum(low[: -(_NEAR - 15)], low[_NEAR - 15 :])
                n = np.diff(bounds)
                doc = np.repeat(np.arange(len(n)), n)
                window = np.flatnonzero(doc[: len(low)] == doc[WINDOW - 1 : WINDOW - 1 + len(low)])
                chosen = np.zeros(len(grams), bool)
                # a window has its anchor at the place where its least gram stands
                for step in range(_NEAR + 1):
                    at = window + step
                    chosen[at[grams[at] == low[window]]] = True
                at = np.flatnonzero(chosen)
                yield pd.DataFrame({
                    "anchor": grams[at].view(np.int64), "digest": part.digest.to_numpy()[doc[at]],
                    "place": (at - bounds[doc[at]]).astype(np.int32)})

    return docs.select("digest", "text").mapInPandas(find, "anchor bigint, digest bigint, place int")


def windows(found: DataFrame) -> DataFrame:
    """Hash and place of each window that holds one of a document's ``places``."""

    def find(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                h, _ = word_hashes([row.text])
                grams = rolled(h, WINDOW)
                wanted = np.zeros(len(grams) + WINDOW, np.int32)
                for p in row.places:
                    wanted[max(0, p - _NEAR)] += 1
                    wanted[p + 1] -= 1
                at = np.flatnonzero(np.cumsum(wanted)[: len(grams)] > 0)
                for s in range(0, max(len(at), 1), 1 << 18):
                    own = at[s : s + (1 << 18)]
                    yield pd.DataFrame({"window": grams[own].view(np.int64), "doc_id": row.doc_id, "place": own.astype(np.int32)})

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "text", "places").mapInPandas(find, f"window bigint, doc_id {kind}, place int")


def runs(placed: DataFrame) -> DataFrame:
    """Windows in a row with one owner: ``doc_id``, ``owner``, ``first`` and ``last`` place."""
    w = Window.partitionBy("doc_id").orderBy("place")
    fresh = (F.col("place") != F.lag("place", 1, -2).over(w) + 1) | (F.col("owner") != F.lag("owner", 1).over(w))
    d = placed.withColumn("fresh", F.coalesce(fresh, F.lit(True)).cast("int"))
    d = d.withColumn("run", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy("doc_id", "run").agg(F.first("owner").alias("owner"), F.min("place").alias("first"), F.max("place").alias("last")).drop("run")


def cut(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """The words of each run, as one text."""

    def take(batches):
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                own = _WORD.findall(row.text)
                for r in row.runs:
                    rows.append((row.doc_id, r["owner"], r["first"], " ".join(own[r["first"] : r["last"] + WINDOW])))
            yield pd.DataFrame(rows, columns=["doc_id", "owner", "first", "words"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    gathered = spans.groupBy("doc_id").agg(F.collect_list(F.struct("owner", "first", "last")).alias("runs"))
    d = texts.select("doc_id", "text").join(gathered, "doc_id")
    return d.mapInPandas(take, f"doc_id {kind}, owner {kind}, first int, words string")


def matched(passages: DataFrame, least: int = WINDOW) -> DataFrame:
    """Spans of streamed passages that the automaton of their shard holds.

    ``passages`` are rows of a ``shard`` and ``salt``: reference if ``owner`` is
    their own document, else streamed.
    """

    def match(part):
        own = part.doc_id == part.owner
        automaton = Automaton()
        for text in part.words[own]:
            automaton.add(text.split(" "))
        rows = []
        for row in part[~own].itertuples(index=False):
            rows += [(row.doc_id, row.first + a, row.first + b) for a, b in automaton.spans(row.words.split(" "), least)]
        return pd.DataFrame(rows, columns=["doc_id", "start", "end"])

    kind = passages.schema["doc_id"].dataType.simpleString()
    return passages.groupBy("shard", "salt").applyInPandas(match, f"doc_id {kind}, start int, end int")


def kept_words(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``n_removed`` and the text of what stays, for documents with spans."""
    gathered = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def clean(batches):
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                own = _WORD.findall(row.text)
                stays = np.ones(len(own), bool)
                for s in row.spans:
                    stays[s["start"] : s["end"]] = False
                kept = " ".join(own[i] for i in np.flatnonzero(stays))
                rows.append((row.doc_id, row.digest, int((~stays).sum()), kept))
            yield pd.DataFrame(rows, columns=["doc_id", "digest", "n_removed", "kept_text"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "digest", "text").join(gathered, "doc_id").mapInPandas(
        clean, f"doc_id {kind}, digest bigint, n_removed bigint, kept_text string")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``.

    Texts are hashed and dealt once; only documents with repeated anchors are
    kept for the later steps, in a table of the shared folder.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text, F.md5(text)).alias("digest"))
    own = rows.select("doc_id", "digest", words(F.col("text")).alias("w"))
    own = settled(own.select("doc_id", "digest", F.size("w").cast("long").alias("n_words"), F.sha2(F.array_join("w", " "), 256).alias("sha")), "kept-words")
    first = own.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first_id"))

    found = settled(anchors(rows.filter("doc_id is not null")), "anchors")
    shared = found.groupBy("anchor").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a <> b").select("anchor")
    places = found.join(shared, "anchor").groupBy("digest").agg(F.collect_set("place").alias("places"))
    wanted = places.join(first, "digest").select("digest", F.col("first_id").alias("doc_id"), "places")
    texts = settled(rows.join(wanted, ["digest", "doc_id"]).dropDuplicates(["digest", "doc_id"]), "repeating-texts")

    seen = settled(windows(texts), "windows")
    owners = seen.groupBy("window").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("other")).filter("owner < other").drop("other")
    spans = settled(runs(seen.join(owners, "window").distinct()), "runs")
    n_shards = max(1, int((spans.filter("doc_id = owner").agg(F.sum(F.expr(f"last - first + {WINDOW}"))).first()[0] or 0) // SHARD_WORDS))
    passages = cut(spans, texts).withColumn("shard", F.pmod(F.xxhash64("owner"), F.lit(n_shards)))
    salts = F.when(F.col("doc_id") == F.col("owner"), F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salts = salts.otherwise(F.array(F.pmod(F.xxhash64("doc_id", "first"), F.lit(SALTS)).cast("int")))
    removed = settled(matched(passages.withColumn("salt", F.explode(salts))), "removed-spans")

    changed = kept_words(texts, removed).select("doc_id", "digest", "n_removed", F.sha2("kept_text", 256).alias("kept"))
    out = own.join(first, "digest", "left").join(changed.dropDuplicates(["doc_id", "digest"]), ["doc_id", "digest"], "left")
    copy = (F.col("doc_id") > F.col("first_id")) & (F.col("n_words") >= WINDOW)
    return out.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"))


def op10_substrings(spark, folder):
    return dedup(load(spark, folder, "documents"))
