"""From raw documents to tokens: quality, near duplicates, secrets, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. ``run`` writes each stage's result to the
shared folder and reads it again as the next one's input, so a lost executor
costs no more than part of a stage.
"""

from pyspark.sql import functions as F

from packetloom.llm import classifier, jaccard, mixing, secrets, sentencepiece
from packetloom.llm.common import load, settled


def quality(spark, docs, sf_dir):
    """Documents in the importance sample; others go."""
    return classifier.stage(spark, docs, sf_dir)


def near_duplicates(spark, docs, sf_dir):
    """One document of each class of near copies."""
    return jaccard.stage(spark, docs, sf_dir)


def masked_secrets(spark, docs, sf_dir):
    """All documents, with secrets masked; the length follows the text."""
    masked = secrets.mask(docs)
    if "n_chars" not in masked.columns:
        return masked
    length = F.when(F.col("text").isNotNull(), F.length("text").cast(masked.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", length)


def mixture(spark, docs, sf_dir):
    """Documents repeated so that all sources weigh alike, in random order."""
    return mixing.mix(docs).select("doc.*")


def encoded(spark, docs, sf_dir):
    """Tokens of each document."""
    return sentencepiece.stage(spark, docs, sf_dir)


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scans", masked_secrets),
    ("source_mixing", mixture),
    ("sentencepiece", encoded),
]

#: Gumbel noise, MinHash and best paths are not for SQL; tests hold brute force against each stage.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = settled(docs, f"pipeline-{name}")
    return docs
