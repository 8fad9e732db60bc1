"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text is segmented into the vocabulary's pieces with the largest sum of
scores. Texts above ``GIANT`` characters are cut into chunks. A chunk yields its
transfer matrix: entry (i, j) is the largest sum of a path that enters i
characters after the chunk's start, where a piece of the chunk before ended,
and leaves j characters after its end. Matrices combine by max and plus, which
is associative; from the best states at the bounds each chunk is traced back on
its own, in another task.

No piece holds a word start behind another character, so every path passes the
word starts. A matrix is therefore the sum of a head and a tail vector unless a
chunk lies within one word; only then it is computed in full.

The scores are those of the model file, taken as log probabilities, whatever
the file's own kind: a file of merges gives the path of best scores, not the
order of its merges. Characters without a piece become bytes.

A null text is encoded as an empty one, with no token. Equal texts have equal
tokens. A text that itself holds U+2581 decodes to blanks there. An empty table
gives an empty result. Other columns are not read, so names cannot clash.
"""

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import load, prepare, settled

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
GIANT = 1 << 15
CHUNK = 1 << 14
#: Scores below this count as this; a character without a piece costs ten more.
FLOOR = -1e5
#: Characters that the library encodes at a time: its sums of scores are single precision.
_STRETCH = 1500
_BLANK = "▁"
#: A stretch ends where a word starts, so no piece crosses its end.
_CUT = re.compile(r"(?<=[^ ])(?= )")


class Vocabulary:
    """Pieces, scores and byte tokens of a model file, and the library's own best path over them."""

    def __init__(self, content: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(content)
        model.trainer_spec.model_type = 1
        self.ids, self.bytes, self.scores = {}, {}, np.zeros(len(model.pieces))
        for i, p in enumerate(model.pieces):
            if p.type in (1, 4):
                p.score = max(p.score, FLOOR)
                self.ids[p.piece] = i
            elif p.type == 6:
                self.bytes[int(p.piece[3:5], 16)] = i
            self.scores[i] = p.score
        self.longest = max(map(len, self.ids))
        self.unknown = min(self.scores[i] for i in self.ids.values()) - 10.0
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())

    def encode_words(self, text: str) -> list[int]:
        """Tokens of a text that starts a word, by the library, in stretches that end at word starts."""
        if not text:
            return []
        cuts, parts, last = [m.start() for m in _CUT.finditer(text)] if len(text) > _STRETCH else [], [], 0
        for a, b in zip(cuts, [*cuts[1:], len(text)], strict=False):
            if b - last > _STRETCH and a > last:
                parts.append(text[last:a])
                last = a + 1  # the blank is put in front of every stretch again
        parts.append(text[last:])
        out = self.library.encode(parts, num_threads=1)
        return out[0] if len(out) == 1 else [t for part in out for t in part]

    def edges(self, text: str, start: int, end: int):
        """(length, token, score) of the pieces at ``start`` that end by ``end``."""
        found = []
        for n in range(1, min(self.longest, end - start) + 1):
            token = self.ids.get(text[start : start + n])
            if token is not None:
                found.append((n, token, self.scores[token]))
        if not found or found[0][0] != 1:
            found.insert(0, (1, None, self.unknown))
        return found

    def paths(self, text: str, first: int, stop: int, entries: dict, end: int):
        """Largest sums from ``entries`` (position: vector of sums) to each position, and the last edge of each.

        Pieces start before ``stop`` and end by ``end``. Of equal sums the one
        with the longest last piece counts.
        """
        best = dict(entries)
        back = {}
        for p in range(first, stop):
            own = best.get(p)
            if own is None:
                continue
            for n, token, score in self.edges(text, p, end):
                new, old = own + score, best.get(p + n)
                if old is None:
                    best[p + n], back[p + n] = new, (p, token)
                else:
                    if new.max() > old.max():
                        back[p + n] = (p, token)
                    best[p + n] = np.maximum(old, new)
        return best, back

    def cuts(self, text: str, stop: int):
        """First and last word start behind another character, up to ``stop``; None without one."""
        first = next((m.start() + 1 for m in re.finditer(f"[^{_BLANK}]{_BLANK}", text[: stop + 1])), None)
        if first is None:
            return None
        last = first
        for m in re.finditer(f"[^{_BLANK}](?={_BLANK})", text[max(first - 1, 0) : stop + 1]):
            last = max(first - 1, 0) + m.start() + 1
        return first, last

    def transfer(self, own: str, ahead: str, last: bool) -> np.ndarray:
        """Max-plus matrix of a chunk over its overhangs: ``longest`` by ``longest`` sums."""
        text, n, size = own + ahead, len(own), self.longest
        out, found = np.full((size, size), -np.inf), self.cuts(own + ahead, n)
        end = n if last else len(text)
        if found is None:
            starts = {e: np.where(np.arange(size) == e, 0.0, -np.inf) for e in range(min(size, n + 1))}
            best = self._sums(text, starts, n, end)
            for s in range(size):
                if n + s in best:
                    out[:, s] = best[n + s]
            return out
        first, final = found
        middle = self.sum_of(self.encode_words(text[first + 1 : final].replace(_BLANK, " "))) if final > first else 0.0
        head = np.full(size, -np.inf)
        for e in range(min(size, first + 1)):
            best, _ = self.paths(text, e, first, {e: np.zeros(1)}, first)
            if first in best:
                head[e] = best[first][0]
        tail = np.full(size, -np.inf)
        best, _ = self.paths(text, final, n, {final: np.zeros(1)}, end)
        for s in range(size):
            if n + s in best:
                tail[s] = best[n + s][0]
        return head[:, None] + middle + tail[None, :]

    def _sums(self, text, starts, stop, end):
        """Largest sums to each position; the vectors hold one for each entry of a chunk."""
        best = dict(starts)
        for p in range(stop):
            own = best.get(p)
            if own is not None:
                for n, _, score in self.edges(text, p, end):
                    best[p + n] = np.maximum(best.get(p + n, -np.inf), own + score)
        return best

    def trace(self, own: str, ahead: str, enter: int, leave: int) -> list[int]:
        """Tokens of a chunk's best path between two overhangs."""
        text, n = own + ahead, len(own)
        found, goal = self.cuts(text, n), n + leave
        if found is None or not enter <= found[0]:
            return self._between(text, enter, goal, n)
        first, final = found
        middle = self.encode_words(text[first + 1 : final].replace(_BLANK, " ")) if final > first else []
        return self._between(text, enter, first, first) + middle + self._between(text, final, goal, n)

    def _between(self, text, a, b, stop):
        if a >= b:
            return []
        _, back = self.paths(text, a, min(stop, b), {a: np.zeros(1)}, b)
        tokens, at = [], b
        while at > a:
            at, token = back[at][0], back[at][1] if back[at][1] is not None else text[back[at][0]]
            tokens.append(token)
        out = []
        for t in reversed(tokens):
            out += [self.bytes[x] for x in t.encode()] if isinstance(t, str) else [t]
        return out

    def sum_of(self, tokens) -> float:
        """Score of tokens; the bytes of a character count as one without a piece."""
        byte = {i: b for b, i in self.bytes.items()}
        total = 0.0
        for t in tokens:
            b = byte.get(t)
            if b is None:
                total += self.scores[t]
            elif b & 0xC0 != 0x80:
                total += self.unknown
        return total

    def decode(self, tokens) -> str:
        return self.library.decode(tokens)


_OPEN: dict[int, Vocabulary] = {}


def _of(shared) -> Vocabulary:
    """The vocabulary of a broadcast model file, opened once a Python worker."""
    key = hash(shared.value)
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = Vocabulary(shared.value)
    return _OPEN[key]


def content(path: str, most: int = 64 << 20) -> bytes:
    """A model file that is small enough to be broadcast."""
    with open(path, "rb") as f:
        out = f.read(most + 1)
    if len(out) > most:
        raise ValueError(f"{path} is larger than {most} bytes")
    return out


def best_states(matrices: list[np.ndarray]) -> list[int]:
    """Overhang at each bound of the chunks, from prefix products of their matrices.

    The start has overhang 0 and so has the end.
    """
    prefix = [np.where(np.arange(len(matrices[0])) == 0, 0.0, -np.inf)]
    for m in matrices:
        prefix.append((prefix[-1][:, None] + m).max(0))
    states = [0]
    for m, before in zip(reversed(matrices), reversed(prefix[:-1]), strict=True):
        states.append(int(np.argmax(before + m[:, states[-1]])))
    return states[::-1]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL,
           giant_chars: int = GIANT, chunk_chars: int = CHUNK) -> DataFrame:
    """``doc_id`` and ``ids`` of each document."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(content(model))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.md5(text).alias("key"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    giant = F.length("text") > giant_chars

    def direct(batches):
        v = _of(shared)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for s in range(0, len(texts), 256):
                found = [v.encode_words(t) for t in texts[s : s + 256]]
                yield pa.record_batch([batch.column("doc_id").slice(s, 256), _lists(found)], names=["doc_id", "ids"])

    short = rows.filter(~giant).select("doc_id", "text").mapInArrow(direct, f"doc_id {kind}, ids array<int>")

    def chunks(batches):
        v = _of(shared)
        for batch in batches:
            for key, t in zip(batch["key"], batch.text, strict=True):
                t = _BLANK + t.replace(" ", _BLANK)
                for i, s in enumerate(range(0, len(t), chunk_chars)):
                    e = s + chunk_chars
                    yield pd.DataFrame({"key": [key], "chunk": [i], "own": [t[s:e]], "ahead": [t[e : e + v.longest - 1]], "last": [e >= len(t)]})

    cut = rows.filter(giant).select("key", "text").mapInPandas(chunks, "key string, chunk int, own string, ahead string, last boolean")
    cut = settled(cut.dropDuplicates(["key", "chunk"]), "text-chunks")

    def transfers(batches):
        v = _of(shared)
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "chunk": batch.chunk, "matrix": [
                v.transfer(*x).ravel() for x in zip(batch.own, batch.ahead, batch["last"], strict=True)]})

    def states(part):
        part = part.sort_values("chunk")
        side = int(round(len(part.matrix.iloc[0]) ** 0.5))
        at = best_states([np.asarray(m, float).reshape(side, side) for m in part.matrix])
        return pd.DataFrame({"key": part["key"], "chunk": part.chunk, "enter": at[:-1], "leave": at[1:]})

    matrices = cut.mapInPandas(transfers, "key string, chunk int, matrix array<double>")
    bounds = matrices.groupBy("key").applyInPandas(states, "key string, chunk int, enter int, leave int")

    def traced(batches):
        v = _of(shared)
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "chunk": batch.chunk, "ids": [
                v.trace(*x) for x in zip(batch.own, batch.ahead, batch.enter, batch.leave, strict=True)]})

    d = cut.join(bounds, ["key", "chunk"]).select("key", "chunk", "own", "ahead", "enter", "leave")
    d = d.mapInPandas(traced, "key string, chunk int, ids array<int>")
    d = d.groupBy("key").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("ids"))
    long = rows.filter(giant).select("doc_id", "key").join(d, "key").select("doc_id", "ids")
    return short.unionByName(long)


def decode(tokens: DataFrame, ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """``tokens`` with ``decoded``, the text of its ids."""
    prepare(tokens.sparkSession)
    shared = tokens.sparkSession.sparkContext.broadcast(content(model))

    @F.pandas_udf("string")
    def text_of(ids: pd.Series) -> pd.Series:
        v = _of(shared)
        return pd.Series([v.decode(x.tolist()) if x is not None and len(x) else "" for x in ids])

    return tokens.withColumn("decoded", text_of(F.col(ids_col)))


def _lists(found) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in found]).astype(np.int32)
    values = np.fromiter((t for x in found for t in x), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def tokens_of(docs: DataFrame, model: str = MODEL, **sizes) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and the digest of the decoded text."""
    d = decode(encode(docs, model=model, **sizes), model=model)
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.md5("decoded").alias("decoded_md5"))


def stage(spark, docs, folder):
    return tokens_of(docs)


def op2_sentencepiece(spark, folder):
    return tokens_of(load(spark, folder, "documents").select("doc_id", "text"))
