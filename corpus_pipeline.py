"""A training corpus from raw documents: five stages, each over all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from assay.llm import langid, minhash, mixing, packing, secrets
from assay.llm.queries import vocabulary
from assay.scratch import Scratch

#: A text whose best language scores below this is rejected, as is one without letters.
LEAST_LANGUAGE_SCORE = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is recognised.

    Texts that are null, empty or without letters go; without any label to learn from all go. Whole texts are read,
    repeated rows and null ids stay, columns may have any names, and an empty table gives an empty one.
    """
    return langid.recognised(docs, langid.fit(docs), least=LEAST_LANGUAGE_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies (five-word shingles, similarity 0.8) the document with the smallest id, once.

    Rows without an id stay, as do null, empty and blank texts. Of rows that share an id the one with the smallest hash
    of all its values stays, so a tie is settled alike in every run. Whole texts are compared; an empty table gives an empty one.
    """
    kept = minhash.near_duplicates(docs, width=5).where("kept and id is not null").select("id").distinct()
    here = F.col("doc_id").cast("long")
    rows = docs.select(F.struct("*").alias("row"), here.alias("id"))
    named = rows.where("id is not null").join(kept, "id", "left_semi")
    value = F.xxhash64(F.to_json("row"))
    repeated = docs.where(here.isNotNull()).groupBy(here.alias("id")).count().where("count > 1").select("id")
    repeated = Scratch(spark, "repeated").save(repeated, "ids")
    if not repeated.isEmpty():
        # only rows whose ids repeat are shuffled again; the minimum combines before that
        single = named.join(repeated, "id", "left_anti")
        once = named.join(repeated, "id", "left_semi").groupBy("id").agg(F.min_by("row", value).alias("row"))
        named = single.select("row").unionByName(once.select("row"))
    return named.select("row").unionByName(rows.where("id is null").select("row")).select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, with its secrets masked; the length column follows where there is one.

    Null texts stay null, and repeated rows, null ids and texts without findings stay as they are; whole texts are
    scanned, columns may have any names, and an empty table gives an empty one.
    """
    out = secrets.mask_secrets(docs, secrets.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, those in it twice as two rows.

    Null and empty texts have no words and follow their neighbours in the queue; a null source is a source, and one without any words
    goes; equal rows and null ids are told apart by count. Columns may have any names; an empty table gives an empty one.
    """
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place.

    Null and empty texts are one piece of the end id; only texts longer than a sequence are cut; repeated rows and null
    ids are packed like any other; other columns are ignored, and an empty table gives no piece.
    """
    return packing.pack_documents(docs, vocabulary(), keep_ids=False)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written before the next reads them."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language models, near-duplicate links and packing aren't expressed in SQL; the tests hold run() against brute force.
ORACLE_SQL = None
