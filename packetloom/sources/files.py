"""Flow, packet, report and upload files."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.operators.catalog import named_uploads, register_accepted, upload_file
from packetloom.operators.uploads import EXTENSION, cleaned_text
from packetloom.schemas import FLOWS, PACKETS
from packetloom.session import run_folder
from packetloom.sources.binary import pack_files, write_files
from packetloom.sources.shared import Store

#: Spark writes this file last.
MARK = "_SUCCESS"


def read_flows_csv(spark, path, schema=FLOWS, class_column="label"):
    """CSV flows with a header.

    Types come from ``schema`` by header name, so the data is read once;
    columns it does not name are strings. ``schema=None`` infers types from all
    rows instead and then casts the class column to string. A value that does
    not fit its type, and a file whose header differs from the first one's,
    raise an error instead of giving NULL or another column's values.
    """
    reader = spark.read.options(header=True, enforceSchema=False, mode="FAILFAST")
    if schema is None:
        flows = reader.options(inferSchema=True).csv(path)
        return flows.withColumn(class_column, F.col(class_column).cast("string"))
    kinds = {field.name.lower(): field.dataType for field in schema.fields}
    header = reader.csv(path).columns
    typed = T.StructType(
        [T.StructField(name, kinds.get(name.lower(), T.StringType())) for name in header]
    )
    return reader.schema(typed).csv(path)


def write_flows(flows, path, mode="overwrite", partition_by=()):
    """Flows as Parquet; optionally in folders, e.g. by day, never by address."""
    flows.write.mode(mode).partitionBy(*partition_by).parquet(path)


def load_flows(spark, path, view=None, schema=None):
    """Parquet flows; also registered as a temporary view if ``view`` is given.

    Every column of the files is taken unless ``schema`` names some; the known
    ones are named as in ``FLOWS`` whatever their case.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    flows = reader.parquet(path)
    known = {name.lower(): name for name in FLOWS.names}
    flows = flows.toDF(*[known.get(name.lower(), name) for name in flows.columns])
    if view:
        flows.createOrReplaceTempView(view)
    return flows


def recover(spark, path):
    """Finish or undo a replacement that broke off; returns whether a whole table stands at ``path``."""
    path = path.rstrip("/")
    store, new, old = Store(spark, path), f"{path}._new", f"{path}._old"
    if not store.exists(path):
        if store.exists(f"{new}/{MARK}"):
            store.rename(new, path)
        elif store.exists(old):
            store.rename(old, path)
    whole = store.exists(f"{path}/{MARK}")
    if whole:
        store.delete(old)
    store.delete(new)
    return whole


def replace_table(rows, path, format="parquet", partition_by=()):
    """Replace the table at ``path``: readers find the old or the new one, also after a crash.

    The new table is written beside the old one and takes its place by two
    renames; a call that broke off is finished or undone by the next one, or by
    ``recover``. One writer at a time; several need ``sources.snapshots``.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    recover(spark, path)
    store, new, old = Store(spark, path), f"{path}._new", f"{path}._old"
    rows.write.partitionBy(*partition_by).format(format).save(new)
    if store.exists(path):
        store.delete(old)
        store.rename(path, old)
    store.rename(new, path)
    store.delete(old)


def ingest_if_absent(spark, csv_path, parquet_path, schema=FLOWS):
    """Convert CSV to Parquet unless a whole Parquet table exists; open the table.

    What a call that broke off has left is no table: it is written anew.
    """
    if not recover(spark, parquet_path):
        replace_table(read_flows_csv(spark, csv_path, schema), parquet_path)
    return load_flows(spark, parquet_path, schema=None)


def load_packets(spark, path, format="json"):
    """Packet rows from a landing folder; missing fields are NULL.

    ``format`` may name any source on the class path, e.g. a document store.
    """
    return spark.read.format(format).schema(PACKETS).load(path)


def save_report(report, path, format="parquet"):
    """Save a query result as a report table, replacing the last one."""
    replace_table(report, path, format)


def append(rows, path):
    """Append rows to a packet, alert or audit table."""
    rows.write.mode("append").parquet(path)


def mount_views(spark, sources):
    """Register each source as a temporary view unless its name is taken.

    ``sources`` maps a view name to a function that opens the source; sources
    that are mounted already are not opened again.
    """
    for name, open_source in sources.items():
        if not spark.catalog.tableExists(name):
            open_source().createOrReplaceTempView(name)


def read_uploads(spark, folder):
    """The upload folder twice: every file, and those with the right name.

    The first frame serves for size and name (no bytes are read for those);
    the second is where contents are read. Pass both to ``screen_uploads``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    any_case = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in EXTENSION)
    return reader.load(folder), reader.option("pathGlobFilter", f"*{any_case}").load(folder)


def ingest_uploads(catalog, accepted, folder, at, packed=False):
    """Write the cleaned file of every accepted upload to ``folder``; the catalog with what was written.

    Each file keeps its delimiter and stands where its catalog entry says. A file
    comes under its name whole; an upload that was not written is not registered.
    A disk has room for some millions of files, so for more uploads they are ``packed``:
    many cleaned files in one stored file, which ``sources.binary.read_files`` reads by their locations.
    """
    spark, folder = accepted.sparkSession, folder.rstrip("/")
    text = F.encode(cleaned_text(F.col("text"), F.col("delimiter")), "UTF-8")
    done = run_folder(spark, "written-uploads")
    files = named_uploads(accepted).select(upload_file().alias("name"), text.alias("content"))
    if packed:
        pack_files(files, folder).write.parquet(done)
        # of files of one name one stays
        # of files of one name one stays; the name is made before the join, which would make it for each comparison
        stored = spark.read.schema("name string, path string").parquet(done)
        written = stored.groupBy(F.col("name").alias("written_name")).agg(F.max("path").alias("written"))
        kept = accepted.withColumn("written_name", upload_file()).join(written, "written_name")
        return register_accepted(catalog, kept, folder, at, F.col("written"))
    write_files(files, folder).write.parquet(done)
    written = spark.read.schema("path string, length bigint").parquet(done).select(F.col("path").alias("written"))
    location = F.concat(F.lit(f"{folder}/"), upload_file())
    kept = accepted.join(written, location == F.col("written"), "left_semi")
    return register_accepted(catalog, kept, folder, at)
