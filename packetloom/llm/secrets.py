"""Secrets with multipart credential linking.

Strong parts (assignments, access keys, long hex runs) are always reported.
Weak parts (logins, short values, mixed tokens, endpoints) are reported only if
a complementary part stands within ``SCOPE`` code points: a secret for a login
or an endpoint, a login, access key or endpoint for a secret. Two parts that
overlap are no partners, and a hex run or mixed token inside an endpoint is a
piece of that address, nobody's partner. The parts are joined as intervals: each
is put into a bucket of the scope's width, and a weak part meets those of its own
and the two neighbouring buckets. Parts of a kind never overlap, so a bucket holds
some hundred at most, whatever the text.

A null text is empty and has no span. Equal texts share their result, so
repeated rows each get it. Matches of one kind never overlap; a
place may be in spans of several kinds. An empty table gives an empty result.
Only the id and text columns are read, so other columns cannot clash.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import file_limit, load, settled

SCOPE = 200
#: Patterns, with the number of the group that holds the value.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = {
    "assign": (ASSIGN, 2),
    "access": (r"AKIA[A-Z0-9]{14,}", 0),
    "hex": (r"[0-9a-f]{16,}", 0),
    "login": (r"""(?i:username|user_id|login|account|client_id|key_id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""", 1),
    "short": (ASSIGN, 2),
    "token": (r"[A-Za-z0-9+/_-]{20,}", 0),
    "endpoint": (r"""(?:https?|ftps?|wss?|ssh|postgresql|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D"'<>]+"""
                 r"""|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])""", 0),
}
NAMES = list(KINDS)
BASE = ("assign", "access", "hex")
#: Secrets on one side; what they open, or who uses them, on the other.
SECRET = ("assign", "hex", "short", "token")


def _kept(kind):
    """Condition on a match's value ``v``; other matches only take up their place."""
    v = F.col("v")
    if kind == "assign":
        return F.length(v) >= 12
    if kind == "short":
        return F.length(v).between(6, 11)
    if kind == "token":
        return v.rlike("[0-9]") & v.rlike("[A-Z]") & v.rlike("[a-z]")
    return F.lit(True)


def parts(texts: DataFrame) -> DataFrame:
    """Every part of distinct texts ``(key, text)``: kind, start, end in code points.

    The pieces between matches give the places: a match starts after all
    earlier pieces and matches of its text.
    """
    t, found = F.col("text"), []
    d = texts.select("key", "text", *[F.regexp_extract_all(t, F.lit(p), F.lit(0)).alias(k) for k, (p, _) in KINDS.items() if k != "short"])
    for kind, (pattern, group) in KINDS.items():
        name = "assign" if kind == "short" else kind
        if kind == "short":
            continue
        some = F.size(name) > 0
        values = F.regexp_extract_all(t, F.lit(pattern), F.lit(group)) if group else F.col(name)
        found.append(F.when(some, F.arrays_zip(
            F.transform(F.split(t, pattern, -1), F.length).alias("gap"),
            F.transform(name, F.length).alias("length"),
            values.alias("v"),
        )).alias(f"all_{kind}"))
    names = [k for k in KINDS if k != "short"]
    any_part = F.greatest(*[F.size(k) for k in names]) > 0
    d = d.filter(any_part).select("key", *found)
    d = d.groupBy("key").agg(*[F.first(f"all_{k}").alias(f"all_{k}") for k in names])
    stacked = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.coalesce(f"all_{k}", F.array().cast(d.schema[f"all_{k}"].dataType)).alias("m")) for k in names]))
    d = d.select("key", stacked.alias("s")).select("key", "s.kind", F.posexplode("s.m").alias("i", "m"))
    before = Window.partitionBy("key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("m.gap") + F.coalesce("m.length", F.lit(0))).over(before)
    d = d.select("key", "kind", F.col("m.v").alias("v"), F.col("m.length").alias("length"), end.alias("end"))
    d = d.filter(F.col("length").isNotNull()).select("key", "kind", "v", (F.col("end") - F.col("length")).alias("start"), "end")
    kind = F.when((F.col("kind") == "assign") & (F.length("v") < 12), "short").otherwise(F.col("kind"))
    d = d.withColumn("kind", kind)
    keep = F.lit(False)
    for k in KINDS:
        keep = keep | ((F.col("kind") == k) & _kept(k))
    return d.filter(keep).drop("v")


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Strong parts, and weak parts with a complementary part in their scope that they do not overlap."""
    start, end, bucket = F.col("start"), F.col("end"), F.floor(F.col("start") / scope)
    d = found.withColumn("is_secret", F.col("kind").isin(*SECRET)).withColumn("bucket", bucket)
    place = F.struct("start", "end")
    covers = found.filter("kind = 'endpoint'").withColumn("bucket", F.explode(F.sequence(bucket, F.floor((end - 1) / scope))))
    covers = covers.groupBy("key", "bucket").agg(F.collect_list(place).alias("covers"))
    covered = F.exists("covers", lambda c: (c["start"] <= start) & (start < c["end"]))
    own = d.join(covers, ["key", "bucket"], "left")
    own = own.filter(~F.col("kind").isin("hex", "token") | F.col("covers").isNull() | ~covered).drop("covers")
    partners = own.groupBy("key", (~F.col("is_secret")).alias("is_secret"), "bucket").agg(F.collect_list(place).alias("partners"))
    near = own.filter(~F.col("kind").isin(*BASE)).withColumn("bucket", F.explode(F.sequence(bucket - 1, bucket + 1)))
    near = near.join(partners, ["key", "is_secret", "bucket"]).filter(F.exists("partners", lambda p: (
        (F.abs(p["start"] - start) <= scope) & ((p["end"] <= start) | (p["start"] >= end)))))
    near = near.select("key", "kind", "start", "end").distinct()
    return d.filter(F.col("kind").isin(*BASE)).select("key", "kind", "start", "end").unionByName(near)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``spans`` as sorted structs of start, kind and end.

    Found parts are written to the shared folder once; they are few, whatever
    the texts hold.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), F.md5(text).alias("key"), text.alias("text"))
    found = settled(parts(d.select("key", "text")), "secret-parts")
    order = F.array_position(F.array(*map(F.lit, NAMES)), F.col("kind"))
    spans = linked(found, scope).groupBy("key").agg(F.sort_array(F.collect_list(
        F.struct(F.col("start").alias("start"), order.alias("rank"), F.col("kind").alias("kind"), F.col("end").alias("end")))).alias("spans"))
    # written, so that the join has a shuffle of its own, which adaptive
    # execution can split where one text stands on very many rows
    spans = settled(spans, "secret-spans")
    out = d.select("doc_id", "key").join(spans, "key", "left").drop("key")
    return out.withColumn("spans", F.coalesce("spans", F.array().cast(out.schema["spans"].dataType)))


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span replaced by ``mark``; all columns stay.

    Overlapping spans are masked as one. The text is cut by the spans of its
    own row, so the join is by the text's digest, as in ``scan``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    files = file_limit(docs.sparkSession, docs.count())
    found = settled(parts(docs.select(F.md5(text).alias("key"), text.alias("text"))), "secret-parts", files)
    each = Window.partitionBy("key").orderBy("start", "end")
    reach = F.max("end").over(each.rowsBetween(Window.unboundedPreceding, -1))
    d = linked(found).withColumn("fresh", (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int"))
    d = d.withColumn("run", F.sum("fresh").over(each.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.groupBy("key", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    # what stays: from the end of one run to the start of the next
    last = F.lag("end", 1, 0).over(Window.partitionBy("key").orderBy("start"))
    d = d.withColumn("from", last)
    cuts = d.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("from", "start"))).alias("cuts"), F.max("end").alias("rest"))
    cuts = settled(cuts, "secret-cuts", files)
    rows = docs.select(F.struct("*").alias("doc"), F.md5(text).alias("key")).join(cuts, "key", "left")
    own = F.col(f"doc.`{text_col}`")
    kept = F.transform("cuts", lambda c: own.substr(c["from"].cast("int") + 1, (c["start"] - c["from"]).cast("int")))
    tail = own.substr(F.col("rest").cast("int") + 1, F.length(own))
    clean = F.when(F.col("cuts").isNull(), own).otherwise(F.array_join(F.concat(kept, F.array(tail)), mark))
    return rows.select(F.col("doc").withField(f"`{text_col}`", clean).alias("doc")).select("doc.*")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_secrets(spark, folder):
    d = scan(load(spark, folder, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return d.select("doc_id", *[count(k) for k in BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
