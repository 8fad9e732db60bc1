"""Conversation trie, filter audit and language ID against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.llm import conversation_trie, filter_audit, language_id

FOLDER = "/root/testdata/sf0.001"
SPACES = " \t\n\v\f\r"


def by_sql(name, sql, folder=FOLDER, **tables):
    con = duckdb.connect()
    for table in ("documents", "labels", "conversations"):
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    con.execute(sql)
    return sorted(map(repr, con.fetchall())), [c[0] for c in con.description]


@pytest.mark.parametrize("name, query, sql", [
    ("op12", conversation_trie.op12_conversation_trie, conversation_trie.ORACLE),
    ("op13", filter_audit.op13_filter_audit, filter_audit.ORACLE)])
def test_same_as_sql(spark, name, query, sql):
    want, columns = by_sql(name, sql)
    assert sorted(map(repr, map(tuple, query(spark, FOLDER).select(*columns).collect()))) == want


# conversation trie

def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))

    def order(t):
        return t[:2] + (hashlib.md5(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).digest(),)

    own = {c: [t[2:] for t in sorted(turns, key=order)] for c, turns in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        head = c - int(np.fmod(c, 5))
        full[c] = tuple(own.get(head, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in full.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, convs in members.items():
        cost = (len(convs) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += cost
    return sorted((
        min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), kids[p], leaves[p], saved[p],
        hashlib.sha256(",".join(map(str, sorted(c for c in convs if full[c] == p))).encode()).hexdigest(),
    ) for p, convs in members.items())


def nodes(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(r[n] for n in names) for r in df.collect())


SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, sizes string, name string, part string"


def talk(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-50, 3 * n), n):
        for t in range(rng.choice([0, 1, 2, 3, 12, 30])):
            words = rng.choice(["a", "b", "é"]) * rng.choice([1, 1, 2])
            rows.append((c, None if rng.random() < 0.05 else t, rng.choice(["user", "user", None]), rng.choice([words, words, "x", None])))
    rows += [(7000 + c, t, "user", f"hot {t}") for c in range(200) for t in range(3)]
    rows += [(1 << 60, 0, "user", "far"), (None, 0, "user", "nobody's"), (9003, 0, "u", "same"), (9003, 0, "u", "same"), (9004, 5, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_over_many_tasks(spark, monkeypatch, seed):
    monkeypatch.setattr(conversation_trie, "FAN", 2)
    rows = talk(seed)
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = nodes(conversation_trie.trie(df))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == brute_trie(rows)


def test_trie_of_no_conversation(spark):
    assert nodes(conversation_trie.trie(spark.createDataFrame([], SCHEMA))) == []
    assert nodes(conversation_trie.trie(spark.createDataFrame([(None, 1, "u", "t", "", "", "", "")], SCHEMA))) == []


def test_forests_merge_like_one(monkeypatch):
    """Any cut of the sorted strings into batches and tasks gives the same nodes."""
    rng = random.Random(5)
    turn = [bytes([k]) * conversation_trie.WIDE for k in range(3)]
    strings = sorted({b"".join(rng.choices(turn, k=rng.randrange(9))) for _ in range(300)})

    def parts(keys):
        return [conversation_trie.Part(k, [7] * 9, i, i % 3 + 1, ends=str(i)) for i, k in enumerate(strings) if k in keys]

    def plain(rows):
        return sorted((r["depth"], r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends"]) for r in rows)

    want, rest = conversation_trie.contract(parts(set(strings)), True)
    assert rest == [] and len(want) == len({s[: 16 * d] for s in strings for d in range(len(s) // 16 + 1)})
    for _ in range(20):
        cuts = sorted(rng.sample(range(len(strings)), 6))
        rows, held = [], []
        for a, b in zip([0, *cuts], [*cuts, len(strings)]):
            more, left = conversation_trie.contract(parts(set(strings[a:b])))
            rows, held = rows + more, held + left
        assert len(held) < 6 * 2 * 9
        more, rest = conversation_trie.contract(held, True)
        assert plain(rows + more) == plain(want) and rest == []


# filter audit

def brute_audit(docs, labels):
    def split(t):
        for s in SPACES:
            t = t.replace(s, " ")
        return [w for w in t.split(" ") if w]

    docs = [(i, t or "", p or "") for i, t, p in docs]
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t] = min(i, least.get(t, i))
    good, toxic = ({i for i, *q in labels if q[k] == 1} - {None} for k in (0, 1))
    out = {}
    for part in {p for _, _, p in docs}:
        rows = []
        for i, t, p in docs:
            if p == part:
                w = split(t)
                tests = (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                         any(c in "#$%&*|" for c in t), i is not None and least[t] < i)
                rows.append((i, {f for f, x in zip("ABCDE", tests) if x}))
        removed = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for k, f in enumerate(order):
                now = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                removed[f] += len(now)
                out[part, order, k + 1] = (
                    len(left), len(now), sum(f in r[1] for r in rows) - len(now), sum(r[1] == {f} for r in rows),
                    sum(r[0] in good for r in now), sum(r[0] in toxic for r in now))
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                out[part, order, k + 1] += (removed[f],)
    return out


def audit(spark, docs, labels):
    d = spark.createDataFrame([(*r, "x", "x", "x") for r in docs], "doc_id bigint, text string, lang string, bits string, hash string, part string")
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in filter_audit.audit(d, lab).collect()}


LONG = " ".join(f"w{i}" for i in range(150))
DOCS = [
    (1, None, None), (2, "", "en"), (3, LONG, "en"), (4, LONG, "de"), (4, LONG, "de"), (2, LONG, None), (5, "A# b " * 80, "en"),
    (6, "A# b " * 80, "en"), (None, LONG, "en"), (None, None, "fr"), (7, LONG.upper(), "fr"), (8, LONG + " |", "fr"), (8, LONG + "\x1c|", "fr"), (9, "ÀÉ " * 120, "fr")]
LABELS = [(3, 1, 0), (4, 1, 1), (4, 0, 0), (6, 0, 1), (None, 1, 1), (99, 1, 1), (7, None, None), (8, 1, None)]


def test_audit_against_brute_force(spark):
    assert audit(spark, DOCS, LABELS) == brute_audit(DOCS, LABELS)
    assert audit(spark, [], LABELS) == {}


def test_audit_when_hashes_clash(spark, monkeypatch):
    """With one hash for all texts, the texts themselves decide."""
    monkeypatch.setattr(filter_audit.F, "xxhash64", lambda *c: F.lit(5).cast("long"))
    ids = [(k, t, p) for k, (_, t, p) in enumerate(DOCS)]
    assert audit(spark, ids, LABELS) == brute_audit(ids, LABELS)


# language ID

def test_gradients_are_right():
    rng = np.random.default_rng(0)
    net = language_id.fresh(["a", "b", "c"], rng)
    net.tables, net.loops = [w.astype(float) for w in net.tables], [w.astype(float) for w in net.loops]
    net.offsets, net.out, net.bias = [rng.standard_normal(language_id.UNITS) for _ in range(2)], net.out.astype(float), net.bias.astype(float)
    data, label, weight = rng.integers(97, 110, (5, 6)).astype(np.uint8), np.array([0, 1, 2, 1, 0]), np.array([1, 2, 1, 1, 3.0])
    _, slopes = language_id.gradients(net, data, label, weight)
    for w, slope in zip(net.weights(), slopes, strict=True):
        for _ in range(6):
            at = tuple(int(rng.integers(n)) for n in w.shape)
            at = (int(data[0, 1]), at[1]) if len(w) == 256 else at
            old, step = w[at], 1e-4
            w[at] = old + step
            up, _ = language_id.gradients(net, data, label, weight)
            w[at] = old - step
            down, _ = language_id.gradients(net, data, label, weight)
            w[at] = old
            assert abs((up - down) / (2 * step) - slope[at]) < 1e-3 * max(1, abs(slope[at]))


@pytest.fixture(scope="module")
def found(spark):
    return language_id.op11_language_id(spark, "/root/testdata/sf0.01").toPandas()


def test_held_out_accuracy(spark, found):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    assert sorted(found.doc_id) == sorted(docs.doc_id) and found.score.between(0, 1).all()
    assert all(found.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id])
    both = found.merge(docs, on="doc_id")
    both = both[both.held_out & both.lang.notna()]
    assert (both.lang == both.lang_pred).mean() > 0.99


def test_held_out_rows_teach_nothing(spark):
    schema = "doc_id bigint, text string, lang string"
    texts = [(i, f"der die das {i}" if i % 2 else f"the and of {i}", "de" if i % 2 else "en") for i in range(60)]
    held = [zlib.crc32(str(i).encode()) % 3 == 1 for i, *_ in texts]
    other = [(i, "zzz", "xx") if h else (i, t, x) for (i, t, x), h in zip(texts, held)]
    assert any(held)
    a, b = (language_id.sampled(spark.createDataFrame(t, schema)).toPandas() for t in (texts, other))
    assert a.equals(b) and set(a.lang) == {"de", "en"}


@pytest.fixture(scope="module")
def net(spark):
    docs = [(k, t, x) for k, (t, x) in enumerate([("der die das und nicht", "de"), ("the and of with that", "en")] * 9)]
    return language_id.fit(language_id.sampled(spark.createDataFrame(docs, "doc_id bigint, text string, lang string")).toPandas(), epochs=40)


def test_language_of_awkward_rows(spark, net):
    long = "the and of with " * 200_000
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "DER DIE das"), (4, "DER DIE das"), (None, "that and with"), (5, long), (6, "x" * 3_000_000), (7, "日本"), (8, "1 é")]
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], "doc_id bigint, text string, doc string, score string, read string")
    got = language_id.identify(df, net).select("doc.doc_id", "lang_pred", "score", "labelled", "probabilities").collect()
    assert [(r.doc_id, r.lang_pred) for r in got][:7] == [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "de"), (None, "en"), (5, "en")]
    assert all(r.score == 0 for r in got[:3]) and all(0.5 <= r.score <= 1 for r in got[3:])
    assert sum(got[6].labelled.values()) == len(long.replace(" ", "")) and sum(got[7].labelled.values()) == 3_000_000
    assert abs(sum(got[8].probabilities.values()) - 1) < 1e-9
    assert language_id.identify(df.limit(0), net).count() == 0
    assert {(r.lang_pred, r.score) for r in language_id.identify(df, None).collect()} == {("und", 0.0)}


def test_pooling_is_that_of_single_bytes(net):
    text = "The das und with-" + "a" * 60
    logs = [language_id._log_probabilities(net, np.frombuffer(s, np.uint8)[None])[0][:, 0] for s in language_id.segments(text)]
    mean = np.concatenate(logs).mean(0)
    share, counts = language_id.Reader(net).read([text, None])
    assert np.allclose(share[0], np.exp(mean) / np.exp(mean).sum(), atol=1e-5)
    assert counts[0].sum() == len(text) - 3 and not counts[1].any()
    runs = language_id.spans(net, text)
    assert sum(b - a for a, b, _ in runs) == counts[0].sum() and runs[0][0] == 0 and runs[-1][1] == len(text)
    for k, name in enumerate(net.languages):
        assert sum(b - a for a, b, x in runs if x == name) == counts[0][k]


def test_a_full_memory_changes_nothing(net, monkeypatch):
    texts = ["the and das und", "of with nicht die", None, "that the of"] * 3
    want = language_id.Reader(net).read(texts)[0]
    monkeypatch.setattr(language_id, "CACHE", 3)
    reader = language_id.Reader(net)
    assert np.allclose(want, np.concatenate([reader.read(texts[:2])[0], reader.read(texts[2:])[0]]), atol=1e-6)
