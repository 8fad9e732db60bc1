"""Dataset catalog: build, search, preview, register, remove, freshness."""

import re

from pyspark.sql import functions as F

from packetloom.functions import csvtext
from packetloom.functions.text import strip, zoned_text
from packetloom.schemas import CATALOG, FIELD_LIST

# Ids of the built-in datasets, the id of the live dataset,
# display format and the entries written for an upload.
PROTECTED_IDS = ("ds_historical_nids", "ds_live_sniffer", "ds_llm_models")
LIVE_ID = "ds_live_sniffer"
LAST_UPDATE = "'Ultimo aggiornamento: 'HH:mm:ss '('dd-MM-yyyy')'"
UPLOAD_FORMAT, UPLOAD_FIELD_TYPE = "CSV", "String"


def build_catalog(rows):
    """Catalog table from any frame with its columns; types are enforced."""
    return rows.select(
        [F.col(f.name).cast(f.dataType).alias(f.name) for f in CATALOG.fields]
    )


def field_view(catalog):
    """One row per dataset field, in order."""
    return catalog.select("id", F.posexplode("schema").alias("position", "field")).select(
        "id", "position", "field.name", "field.type", "field.description"
    )


def search_catalog(catalog, pattern=None):
    """Datasets whose name or description matches, any case; none given: all.

    Case is folded for all letters, and a word boundary (``\\b``) looks at ASCII
    word characters only, whatever the Java version takes it to be.
    """
    if not pattern:
        return catalog
    boundary = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"
    portable = re.sub(r"\\(.)", lambda m: boundary if m[1] == "b" else m[0], pattern)
    regex = F.lit(f"(?iu){portable}")
    return catalog.filter(F.rlike("name", regex) | F.rlike("description", regex))


def preview(df, *order, n=10):
    """First ``n`` rows, in ``order`` if one is given."""
    return (df.orderBy(*order) if order else df).limit(n)


def named_uploads(accepted):
    """Uploads whose form has a name and a description."""
    return accepted.filter((strip(F.col("dataset")) != "") & (strip(F.col("description")) != ""))


def upload_file():
    """Name of an upload's cleaned file: a slash in the form's name makes no folder, nothing hides it."""
    stem = F.regexp_replace(F.translate(F.lower("dataset"), " /\\", "___"), "^[._]+", "")
    return F.concat(stem, F.lit("_"), F.md5(F.encode("path", "UTF-8")), F.lit(".csv"))


def register_accepted(catalog, accepted, folder, at, location=None):
    """Add every accepted upload to the catalog.

    ``accepted`` has ``path, file, dataset, description, category, text,
    delimiter``. Uploads with a blank name or description are not registered.
    ``at`` is a timestamp: the time of registration. ``location`` is a column; none
    given: the upload's own file in ``folder``.
    """
    if location is None:
        location = F.concat(F.lit(folder.rstrip("/") + "/"), upload_file())
    moment = F.lit(at).cast("timestamp")
    header = F.get(csvtext.cells(F.col("text"), F.col("delimiter")), F.lit(0))
    fields = F.transform(
        header,
        lambda name: F.struct(
            name.alias("name"),
            F.lit(UPLOAD_FIELD_TYPE).alias("type"),
            F.lit(None).cast("string").alias("description"),
        ),
    )
    key = F.md5(F.encode("path", "UTF-8"))
    entries = named_uploads(accepted).select(
        F.concat(F.lit("ds_"), key).alias("id"),
        F.col("dataset").alias("name"),
        "description",
        F.concat(F.lit("Uploaded File ("), F.col("file"), F.lit(")")).alias("source"),
        F.lit(UPLOAD_FORMAT).alias("format"),
        location.alias("location"),
        "category",
        moment.alias("created_at"),
        fields.cast(FIELD_LIST).alias("schema"),
    )
    return catalog.unionByName(entries)


def deregister(catalog, ids, protected=PROTECTED_IDS):
    """Remove the datasets in ``ids`` (column ``id``) except protected ones."""
    removable = ids.select("id").filter(~F.col("id").isin(*protected))
    return catalog.join(removable, "id", "left_anti")


def dataset_freshness(catalog, packets, zone="UTC"):
    """Record count (live dataset only) and last update of each dataset.

    The packet table is aggregated to one struct, read as a scalar subquery.
    """
    live = packets.agg(
        F.struct(F.count("*").alias("n"), F.max("timestamp").alias("newest"))
    ).scalar()
    is_live = F.col("id") == LIVE_ID
    newest = F.timestamp_micros(F.floor(F.col("live.newest") * 1000000).cast("long"))
    return (
        catalog.withColumn("live", live)
        .withColumn(
            "last_update",
            F.coalesce(F.when(is_live, newest), F.col("created_at")),
        )
        .select(
            "id",
            "name",
            F.when(is_live, F.col("live.n")).alias("records"),
            "last_update",
            zoned_text(F.col("last_update"), zone, LAST_UPDATE).alias("last_update_text"),
        )
    )
