"""N-gram Jaccard join by chosen paths.

Documents are sets of five-word shingles. Each set is embedded as ``COORDS``
MinHash tokens (coordinate, least hash); two sets share a token with the
probability of their similarity. A run splits all sets on sampled tokens: at a
node of its tree each coordinate is chosen with probability
1 / (threshold * COORDS), by a hash of the node, and a set goes on to the
children of its tokens there. Nodes with few sets are compared in full, larger
ones are split again. ``RUNS`` runs with fresh hashes are a batch. The recall is
estimated from the links that one run and two runs have found (Chao's estimator
of unseen kinds), and batches are repeated until it reaches ``TARGET``.

A group of thousands of near copies would fill large nodes of every run, and
splitting does not thin it. So a large node is dense if ``DENSE`` of the pairs in
a sample of it look alike; its sets become one kin and are compared in full, in
blocks, on whole shingle sets. A dense node whose sets are mostly of one kin adds
the others to it, and only these are compared with its sets. A node of a single
kin is left: nothing in it is unknown. ``OPENING`` first runs only look for dense
nodes. Other large nodes are split down to ``DEPTH``; what is still large there is
treated as dense. Of a block, links that join its sets are kept. Candidates from
small nodes that pass the tokens' estimate are verified on the whole sets. At last
the links within each class are counted, every pair of it being judged.

Equal word sequences are one set from the start. A text of one to four words is
one shingle; null and empty texts have none and are alone. Rows without an id
cannot be named in a link: they are returned with null class and no link.
Repeated rows are copies. An empty table gives an empty result. Only the id and
text columns are read, so other columns cannot clash.
"""

import hashlib
import warnings
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import file_limit, load, mixed, pieces, prepare, rolled, settled, word_hashes

WORDS = 5
THRESHOLD = 0.8
COORDS = 64
#: A pair of similarity 0.8 is found in a run with probability 1/2 or so.
RUNS = 12
#: Batches of runs end at this estimated recall, or with the bits of a pair's run mask.
TARGET, BATCHES = 0.95, 5
#: Runs that only look for dense nodes.
OPENING = 4
DEPTH = 4
#: Nodes of at most so many sets are compared in full.
BRUTE = 48
#: Members of a large node that tell how dense it is, about, and the share of their pairs that look alike in a dense one.
SAMPLE, DENSE = 64, 0.2
#: Sets on a side of a block of what is compared in full.
BLOCK = 1024
#: The estimate of a pair to be verified is three standard deviations below the threshold at least.
SLACK = 0.15
SEED = 5

_rng = np.random.default_rng(SEED)
_MUL = _rng.integers(1, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, COORDS, dtype=np.uint64)


def shingles(texts):
    """Per text: digest of its words, and its distinct shingle hashes (sorted)."""
    h, bounds = word_hashes(texts)
    grams = rolled(h, WORDS)
    for a, b in zip(bounds, bounds[1:], strict=False):
        if b - a >= WORDS:
            own = np.unique(grams[a : b - WORDS + 1])
        elif b > a:
            own = rolled(h[a:b], b - a)
        else:
            yield None, np.empty(0, np.uint64)
            continue
        yield hashlib.md5(h[a:b].tobytes()).digest(), own


def tokens(own: np.ndarray) -> np.ndarray:
    """Least hash of a set under each coordinate, 32 bits each; in blocks, so memory is bounded."""
    least = np.full(COORDS, (1 << 32) - 1, np.uint64)
    for i in range(0, len(own), 4096):
        block = own[i : i + 4096, None] * _MUL + _ADD
        least = np.minimum(least, (block >> np.uint64(32)).min(0))
    return least.astype(np.uint32)


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``digest`` of the text, ``node`` (digest of the words) and ``tokens`` of each document."""

    def sign(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                got = [(n, tokens(s).tobytes() if n else None) for n, s in shingles(part.text)]
                yield pd.DataFrame({"doc_id": part.doc_id, "digest": part.digest, "node": [g[0] for g in got], "tokens": [g[1] for g in got]})

    prepare(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), _digest(text_col).alias("digest"))
    return d.mapInPandas(sign, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, digest string, node binary, tokens binary")


def _digest(text_col: str):
    return F.coalesce(F.md5(F.col(text_col)), F.lit(""))


_COORDS_AT = np.arange(COORDS, dtype=np.uint64)
_CHOSEN = np.uint64(int((1 << 64) / (THRESHOLD * COORDS)))


def children(path: int, own: np.ndarray) -> np.ndarray:
    """Paths from ``path`` over the tokens whose coordinates are chosen there."""
    p = np.uint64(path)
    at = np.flatnonzero(mixed((_COORDS_AT + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) ^ p) < _CHOSEN)
    step = (own[at].astype(np.uint64) << np.uint64(32)) | at.astype(np.uint64)
    return mixed(mixed(step) ^ p)


def roots(batch: int) -> np.ndarray:
    """Roots of a batch of runs; batch 0 is the opening."""
    first = 1 + (OPENING + (batch - 1) * RUNS if batch else 0)
    return mixed(np.arange(first, first + (RUNS if batch else OPENING), dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def split(nodes: DataFrame, batch: int | None = None) -> DataFrame:
    """Children of each ``(path, run, node, tokens)``; with ``batch``, of the roots of its runs."""
    start = None if batch is None else roots(batch)

    def go(frames):
        for frame in frames:
            row, run, out = [], [], []
            for i, t in enumerate(frame.tokens):
                own = np.frombuffer(t, np.uint32)
                at = [(int(frame.run.iloc[i]), np.int64(frame.path.iloc[i]).view(np.uint64))] if start is None else enumerate(start)
                for k, p in at:
                    found = children(p, own)
                    out.append(found)
                    row += [i] * len(found)
                    run += [k] * len(found)
            found = np.concatenate(out) if out else np.empty(0, np.uint64)
            yield pd.DataFrame({
                "path": found.view(np.int64), "run": np.array(run, np.int32),
                "node": frame.node.iloc[row].to_numpy(), "tokens": frame.tokens.iloc[row].to_numpy()})

    return nodes.mapInPandas(go, "path bigint, run int, node binary, tokens binary")


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(-1) >= THRESHOLD - SLACK


def compared(small: DataFrame) -> DataFrame:
    """Pairs ``a < b`` that look alike within small nodes, and the run."""
    gathered = small.groupBy("path", "run").agg(F.collect_list(F.struct("node", "tokens")).alias("sets"))

    def pairs(batches):
        for batch in batches:
            left, right, runs = [], [], []
            for run, sets in zip(batch.run, batch.sets, strict=True):
                sets = sorted((bytes(s["node"]), bytes(s["tokens"])) for s in sets)
                t = np.frombuffer(b"".join(x[1] for x in sets), np.uint32).reshape(len(sets), COORDS)
                for i in range(len(sets) - 1):
                    for j in np.flatnonzero(_alike(t[i], t[i + 1 :])):
                        left.append(sets[i][0])
                        right.append(sets[i + 1 + j][0])
                        runs.append(run)
            yield pd.DataFrame({"a": left, "b": right, "run": np.array(runs, np.int32)})

    return gathered.select("run", "sets").mapInPandas(pairs, "a binary, b binary, run int")


def unknown(large: DataFrame, kin: DataFrame) -> DataFrame:
    """Rows of large nodes whose sets are not all of one kin. ``kin`` has ``node`` and ``kin``, maybe several of a set."""
    most = large.join(kin, "node").groupBy("path", "kin").count().groupBy("path").agg(F.max("count").alias("most"))
    return large.join(most, "path", "left").filter("most is null or most < count").drop("most")


def dense(large: DataFrame) -> DataFrame:
    """``path`` of the large nodes in which ``DENSE`` of the pairs of a sample look alike."""
    sample = large.filter(F.pmod(F.xxhash64("node", "path"), "count") < SAMPLE)
    sample = sample.groupBy("path").agg(F.collect_list("tokens").alias("some"))

    def judge(batches):
        for batch in batches:
            got = []
            for some in batch.some:
                t = np.frombuffer(b"".join(map(bytes, some)), np.uint32).reshape(-1, COORDS)
                alike = sum(int(_alike(t[i], t[i + 1 :]).sum()) for i in range(len(t) - 1))
                got.append(alike >= DENSE * len(t) * (len(t) - 1) / 2)
            yield batch.loc[np.array(got, bool), ["path"]]

    return sample.mapInPandas(judge, "path bigint")


def opened(sets: DataFrame, keep=settled) -> DataFrame:
    """``path``, ``node`` and ``count`` of the sets of dense nodes that the opening runs bring up."""
    level = keep(split(sets, 0).select("path", "node"), "paths-0")
    sizes = level.groupBy("path").count().filter(F.col("count") > BRUTE)
    large = keep(level.join(sizes, "path").join(sets, "node"), "nodes-0")
    return keep(large.join(dense(large), "path", "left_semi").select("path", "node", "count"), "dense-0")


def candidates(sets: DataFrame, kin: DataFrame, batch: int, keep=settled) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs that some small node of a run of a batch brings together and that look alike; rows of nodes to be compared in full.

    ``runs`` of a pair has a bit for each run whose small nodes hold it. Paths are
    counted without tokens first: nearly all nodes hold a single set, and only
    those of two or more are joined with tokens.
    """
    found, full, level = [], [], split(sets, batch)
    bit = F.expr(f"shiftleft(cast(1 as bigint), run + {(batch - 1) * RUNS})")
    for depth in range(1, DEPTH + 1):
        level = keep(level.select("path", "run", "node"), f"paths-{batch}-{depth}")
        sizes = level.groupBy("path").count().filter("count > 1")
        joined = keep(level.join(sizes, "path").join(sets, "node").select("path", "run", "node", "tokens", "count"), f"nodes-{batch}-{depth}")
        # written at once: the plan of all levels together would fill the driver
        pairs = compared(joined.filter(F.col("count") <= BRUTE)).select("a", "b", bit.alias("runs"))
        found.append(keep(pairs.groupBy("a", "b").agg(F.bit_or("runs").alias("runs")), f"pairs-{batch}-{depth}"))
        large = keep(unknown(joined.filter(F.col("count") > BRUTE), kin), f"large-{batch}-{depth}")
        if depth == DEPTH:
            full.append(large.select("path", "node", "count"))
        else:
            close = keep(dense(large), f"dense-{batch}-{depth}")
            full.append(large.join(close, "path", "left_semi").select("path", "node", "count"))
            large = large.join(close, "path", "left_anti")
            if large.isEmpty():
                break
            level = split(large.select("path", "run", "node", "tokens"))
    pairs = reduce(DataFrame.unionByName, found).groupBy("a", "b").agg(F.bit_or("runs").alias("runs"))
    return pairs, keep(reduce(DataFrame.unionByName, full), f"full-{batch}")


def newcomers(full: DataFrame, kin: DataFrame) -> DataFrame:
    """``node`` and ``kin`` to be added so that all sets of each node to be compared in full are of one kin.

    It is the one most of the node's sets are of; a set without any stands for
    the largest of its nodes. If that is less than half, the node is a kin of its own.
    """
    largest = full.groupBy("node").agg(F.max(F.struct("count", "path")).alias("m")).join(kin, "node", "left_anti")
    votes = full.join(kin.unionByName(largest.select("node", F.col("m.path").alias("kin"))), "node").groupBy("path", "kin").agg(F.count(F.lit(1)).alias("n"))
    head = votes.groupBy("path").agg(F.max(F.struct("n", "kin")).alias("m")).select("path", "m.*")
    named = full.join(head, "path").withColumn("kin", F.when(2 * F.col("n") >= F.col("count"), F.col("kin")).otherwise(F.col("path")))
    return named.select("node", "kin").distinct().join(kin, ["node", "kin"], "left_anti")


def recall(links: DataFrame, kin: DataFrame) -> float:
    """Estimated share of links found, from the links seen by one and by two runs.

    Links of sets that are of a kin are left out: their nodes are not compared
    in every run. Without a link it is 1.
    """
    n = F.bit_count("runs")
    one, two, seen = links.join(kin.select(F.col("node").alias("a")), "a", "left_anti").agg(
        *[F.count(F.when(c, 1)) for c in (n == 1, n == 2, n > 0)]).first()
    return seen / (seen + one * (one - 1) / (2 * (two + 1))) if seen else 1.0


def shingle_sets(docs: DataFrame, sets: DataFrame, nodes: DataFrame, id_col: str, text_col: str, keep=settled) -> DataFrame:
    """``node`` and ``own``, its whole shingle set as 32-bit hashes.

    Texts of the documents that stand for the sets in question are read again.
    """
    wanted = sets.join(nodes, "node", "left_semi").select(F.col("first_id").alias("id"), F.col("node").alias("wanted"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(wanted, "id")

    def shingle(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                got = [(n, np.unique((s >> np.uint64(32)).astype(np.uint32)).tobytes()) for n, s in shingles(part.text)]
                out = pd.DataFrame({"node": [g[0] for g in got], "own": [g[1] for g in got]})
                # an id may stand on several rows; only the text of the set counts
                yield out[[n is not None and n == bytes(w) for n, w in zip(out.node, part.wanted, strict=True)]]

    return keep(texts.mapInPandas(shingle, "node binary, own binary").dropDuplicates(["node"]), "shingle-sets")


def _linked(x: bytes, y: bytes) -> bool:
    x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
    if min(len(x), len(y)) < THRESHOLD * max(len(x), len(y)) - 1e-9:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= THRESHOLD * (len(x) + len(y) - both) - 1e-9


def verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame, id_col: str, text_col: str, keep=settled) -> DataFrame:
    """Pairs whose whole shingle sets reach the threshold."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    own = shingle_sets(docs, sets, nodes, id_col, text_col, keep)

    def judge(batches):
        for batch in batches:
            yield batch.loc[[_linked(x, y) for x, y in zip(batch.x, batch.y, strict=True)], ["a", "b", "runs"]]

    d = pairs.join(own.select(F.col("node").alias("a"), F.col("own").alias("x")), "a")
    d = d.join(own.select(F.col("node").alias("b"), F.col("own").alias("y")), "b")
    return d.select("a", "b", "runs", "x", "y").mapInPandas(judge, "a binary, b binary, runs bigint")


def _near(x: list, y: list):
    """Index of a set of ``x``, first of a piece of ``y``, and which sets of the piece reach the threshold with it.

    Pieces are of about a million hashes, so memory stays bounded beside the sets.
    """
    size = np.array([len(own) for own in y])
    piece = (np.cumsum(size) - size) >> 20
    for k in np.unique(piece):
        a, b = np.searchsorted(piece, [k, k + 1])
        words, codes = np.unique(np.concatenate(y[a:b]), return_inverse=True)
        first = np.cumsum(size[a:b]) - size[a:b]
        mark = np.zeros(len(words), np.int32)
        for i, own in enumerate(x):
            at = np.searchsorted(words, own)
            at = at[words[np.minimum(at, len(words) - 1)] == own]
            mark[at] = 1
            both = np.add.reduceat(mark[codes], first)
            mark[at] = 0
            yield i, a, both >= THRESHOLD * (len(own) + size[a:b] - both) - 1e-9


def rest_links(rest: DataFrame, root: DataFrame, docs: DataFrame, sets: DataFrame, id_col: str, text_col: str, keep=settled) -> DataFrame | None:
    """Links that join the sets within each path; None if each path has one root.

    Sets of one root (``root`` has ``node``, ``root`` and maybe ``path``) have met.
    In a path, all sets outside its largest root meet all its sets, in blocks of
    ``BLOCK`` by ``BLOCK``, each a group of its own. A link is left out only if
    others of the block join its sets already. At most one link a set comes out
    of a block, so the rows written do not grow with the pairs.
    """
    d = rest.select("path", "node").join(root, [c for c in ("path", "node") if c in root.columns], "left")
    d = d.withColumn("root", F.coalesce("root", "node"))
    sizes = d.groupBy("path", "root").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("path").agg(F.max(F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots"), F.sum("n").alias("n"))
    several = sizes.filter("roots > 1").select("path", F.col("main.root").alias("main"), "n", (F.col("n") - F.col("main.n")).alias("n_out"))
    d = keep(d.join(several, "path").withColumn("out", F.col("root") != F.col("main")).drop("root", "main"), "rest")
    if d.isEmpty():
        return None
    d = d.join(shingle_sets(docs, sets, d.select("node").distinct(), id_col, text_col, keep), "node")
    rows, columns = (F.ceil(F.col(n) / BLOCK).cast("int") for n in ("n_out", "n"))
    at = F.xxhash64("node", "path")
    up_to = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    slim = ["path", "node", "out", "own"]
    left = d.filter("out").select(*slim, F.lit(True).alias("left"), F.pmod(at, rows).cast("int").alias("i"), up_to(columns).alias("j"))
    right = d.select(*slim, F.lit(False).alias("left"), up_to(rows).alias("i"), F.pmod(at, columns).cast("int").alias("j"))

    def meet(block):
        x, y = block[block["left"]], block[~block["left"]]
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": []})
        nx, ny = ([bytes(n) for n in z.node] for z in (x, y))
        names = {n: k for k, n in enumerate(dict.fromkeys(nx + ny))}
        ix, iy = (np.array([names[n] for n in z]) for z in (nx, ny))
        group, later, links = np.arange(len(names)), ~y.out.to_numpy(bool), []
        rank = np.argsort(np.argsort(np.array(list(names), object)))
        for i, first, near in _near(*([np.frombuffer(o, np.uint32) for o in z.own] for z in (x, y))):
            js = iy[first : first + len(near)]
            # two sets outside the largest root meet twice
            for j in js[near & (group[js] != group[ix[i]]) & (later[first : first + len(near)] | (rank[ix[i]] < rank[js]))]:
                if group[j] != group[ix[i]]:
                    links.append(tuple(sorted((nx[i], ny[first + int(np.flatnonzero(js == j)[0])]))))
                    group[group == group[j]] = group[ix[i]]
        return pd.DataFrame(links, columns=["a", "b"])

    return left.unionByName(right).groupBy("path", "i", "j").applyInPandas(meet, "a binary, b binary").distinct()


def components(links: DataFrame, keep=settled) -> DataFrame:
    """``node`` and ``root`` (the least node) of each linked set.

    Large-star and small-star steps in turn; each keeps what is connected and
    halves the way to the root, so few are needed. Every step is written to the
    shared folder.
    """
    edges, before = keep(links.distinct(), "edges-0"), None
    for step in range(1, 60):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("m").alias("a"), "v").filter("a <> v").select("a", F.col("v").alias("b"))
        small = small.union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()
        edges = keep(small.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"edges-{step}")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components: the classes have not settled")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _counts(x, y, nodes_x, nodes_y, rows_y):
    """Rows that stand for the sets of ``y`` that each set of ``x`` is linked to, itself left out."""
    out = [0] * len(x)
    for i, a, near in _near(x, y):
        b = a + len(near)
        out[i] += int(rows_y[a:b][near & (nodes_y[a:b] != nodes_x[i])].sum())
    return out


def link_counts(root: DataFrame, docs: DataFrame, sets: DataFrame, id_col: str, text_col: str, keep=settled) -> DataFrame:
    """``node`` and ``linked``, the rows of all other sets of its class that reach the threshold.

    Every pair of a class is judged on whole shingle sets, whether or not a run
    has compared it, but no pair becomes a row: a set gets one count a block. A
    class of more than ``BLOCK`` sets is cut into blocks, each pair of them a group
    of its own; smaller classes share groups. Two sets alone are linked.
    """
    members = sets.select("node", "rows").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("all"))
    members = keep(members.join(sizes.filter("n > 1"), "root"), "members")
    two = members.filter("n = 2").select("node", (F.col("all") - F.col("rows")).alias("linked"))
    more = members.filter("n > 2")
    total = more.filter(F.col("n") <= BLOCK).count()
    own = shingle_sets(docs, sets, more.select("node"), id_col, text_col, keep)
    d = more.join(own, "node").withColumn("of", F.ceil(F.col("n") / BLOCK).cast("int"))
    lot = F.pmod(F.xxhash64("root"), F.lit(2 * total // BLOCK + 1))
    alone = d.filter("of = 1").select(
        F.lit(None).cast("binary").alias("big"), lot.alias("i"), F.lit(0).alias("j"), "root", "node", "rows", "own", F.lit(True).alias("left"), F.lit(True).alias("right"))
    part, others = F.pmod(F.xxhash64("node"), F.col("of")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("of") - 1))
    big = d.filter("of > 1").withColumn("part", part).withColumn("other", others)
    rest = [F.col("root"), F.col("node"), F.col("rows"), F.col("own")]
    same = F.col("part") == F.col("other")
    left = big.select(F.col("root").alias("big"), F.col("part").cast("bigint").alias("i"), F.col("other").alias("j"), *rest, F.lit(True).alias("left"), same.alias("right"))
    right = big.filter(~same).select(F.col("root").alias("big"), F.col("other").cast("bigint").alias("i"), F.col("part").alias("j"), *rest, F.lit(False).alias("left"), F.lit(True).alias("right"))

    def count(group):
        nodes, linked = [], []
        for _, one in group.groupby(group.root.map(bytes)):
            x, y = one[one.left.to_numpy(bool)], one[one.right.to_numpy(bool)]
            sets_x, sets_y = ([np.frombuffer(o, np.uint32) for o in z.own] for z in (x, y))
            nodes_x, nodes_y = (np.array([bytes(n) for n in z.node], object) for z in (x, y))
            nodes += list(nodes_x)
            linked += _counts(sets_x, sets_y, nodes_x, nodes_y, y.rows.to_numpy()) if len(y) else [0] * len(x)
        return pd.DataFrame({"node": nodes, "linked": np.array(linked, np.int64)})

    counted = alone.unionByName(left).unionByName(right).groupBy("big", "i", "j").applyInPandas(count, "node binary, linked bigint")
    return counted.groupBy("node").agg(F.sum("linked").alias("linked")).unionByName(two)


def all_links(docs: DataFrame, sets: DataFrame, id_col: str, text_col: str, keep=settled) -> tuple[DataFrame, DataFrame]:
    """Links between word sequences, and ``node`` and ``root`` of all that have one."""
    slim, spark = sets.select("node", "tokens"), docs.sparkSession
    kin = spark.createDataFrame([], "node binary, kin bigint")
    links = spark.createDataFrame([], "a binary, b binary, runs bigint")

    def gathered(full, batch):
        """Links within the sets to be compared in full, and the kin with them."""
        new = keep(newcomers(full, kin), f"new-{batch}")
        met = kin.join(new.select("kin").distinct(), "kin", "left_semi").select("node", "kin")
        everyone = met.unionByName(new).select(F.col("kin").alias("path"), "node")
        # the sets that were of a kin before have met
        before = met.select("node", F.col("kin").alias("path"), F.col("kin").cast("string").cast("binary").alias("root"))
        more = rest_links(everyone, before, docs, sets, id_col, text_col, keep)
        return more, keep(kin.unionByName(new), f"kin-{batch}")

    for batch in range(BATCHES + 1):
        if batch:
            pairs, full = candidates(slim, kin, batch, keep)
            # pairs that earlier batches verified only add their runs
            links = links.unionByName(verified(docs, sets, pairs, id_col, text_col, keep))
        else:
            full = opened(slim, keep)
        if not full.isEmpty():
            more, kin = gathered(full, batch)
            if more is not None:
                links = links.unionByName(more.withColumn("runs", F.lit(0).cast("bigint")))
        links = keep(links.groupBy("a", "b").agg(F.bit_or("runs").alias("runs")), f"links-{batch}")
        if batch and (found := recall(links, kin)) >= TARGET:
            break
    else:
        warnings.warn(f"estimated recall of the links is {found:.3f} after {BATCHES * RUNS} runs", stacklevel=2)
    links = links.select("a", "b")
    return links, components(links, keep)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counted: bool = True) -> DataFrame:
    """``join`` with ``digest`` of the text and ``root``, the class itself; null for rows of no word or id.

    Without ``counted``, ``n_links`` counts the links that the runs have verified only.
    """
    signed = settled(signatures(docs, id_col, text_col), "signatures")
    # dozens of small tables follow: a file a partition would cost more than the rows in it
    keep = partial(settled, files=file_limit(docs.sparkSession, signed.count()))
    known = signed.filter("node is not null and doc_id is not null")
    sets = keep(known.groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("rows"), F.first("tokens").alias("tokens")), "sets")
    links, root = all_links(docs, sets, id_col, text_col, keep)
    if counted:
        linked = link_counts(root, docs, sets, id_col, text_col, keep)
    else:
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rows = sets.select(F.col("node").alias("b"), F.col("rows").alias("b_rows"))
        linked = ends.join(rows, "b").groupBy(F.col("a").alias("node")).agg(F.sum("b_rows").alias("linked"))
    d = sets.select("node", "first_id", "rows").join(linked, "node", "left").join(root, "node", "left")
    d = d.withColumn("root", F.coalesce("root", "node"))
    least = d.groupBy("root").agg(F.min("first_id").alias("class_id"))
    d = d.join(least, "root").select(
        "node", "root", "class_id", (F.col("rows") - 1).alias("copies"), (F.coalesce("linked", F.lit(0)) + F.col("rows") - 1).alias("n_links"))
    out = signed.select("doc_id", "digest", "node").join(d, "node", "left")
    alone = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    named = F.col("doc_id").isNotNull()
    return out.select(
        "doc_id", alone.alias("class_id"), F.when(named, F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"),
        F.when(named, F.coalesce("copies", F.lit(0))).otherwise(0).alias("copies"), "digest", "root")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (least id of its class), ``n_links`` and ``copies``.

    ``copies`` counts the other rows of equal words. ``n_links`` counts these and
    the rows of every other word sequence of the class that reaches the threshold,
    whether or not a run has compared the two.
    """
    return classes(docs, id_col, text_col).drop("digest", "root")


def stage(spark, docs, folder):
    """One document of each class: that of the least id, of its texts the one of least digest.

    Rows without an id stay. Of rows that repeat the document one stays; another
    text under the same id is judged by its own class.
    """
    own = classes(docs, counted=False).filter("doc_id = class_id")
    alone = F.when(F.col("root").isNull(), F.col("digest")).alias("alone")
    keep = own.groupBy("class_id", "root", alone).agg(F.min("digest").alias("digest"))
    keep = keep.select(F.col("class_id").alias("kept_id"), "digest").distinct()
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("kept_id"), _digest("text").alias("digest"))
    first = rows.join(keep, ["kept_id", "digest"], "left_semi")
    once = first.groupBy("kept_id", "digest").agg(F.min("doc").alias("doc")).select("doc")
    return once.unionByName(rows.filter("kept_id is null").select("doc")).select("doc.*")


def op8_jaccard(spark, folder):
    return join(load(spark, folder, "documents"))
