"""A corpus from raw documents to packed sequences, as five stages that each read what the one before wrote.

Language identification, exact deduplication, near-deduplication, mixing of sources and packing. Every stage takes
``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import exact, language, mixing, omh, packing
from foliospark.llm.common import remainder
from foliospark.session import scratch_path, ship_packages


#: What holds for all stages: null texts count as empty and are rejected by the first stage, as are texts without letters;
#: texts of any length are used whole; null ids, languages and sources are values like others; extra columns, whatever
#: their names, are carried on by all stages but the last; an empty table gives an empty table.


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose text is in a language of the corpus, and fill in a null ``lang``.

    Profiles are learnt from the rows whose crc32(doc_id) mod 3 is not 1, and so is the least score by which a text is in
    one of these languages (`language.least_score`). Rejected are null texts, texts without letters and texts that are
    too far from every profile. Ties go to the first language by name; repeated rows all stay or all go.
    """
    ship_packages(spark)
    known = docs.where(remainder("doc_id", 3) != 1)
    profiles = language.learn_profiles(known)
    return language.in_known_language(docs, profiles, least=language.least_score(known, profiles), lang_col="lang")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, white space aside, keep the one with the smallest id.

    A null id only stays where all ids are null. Of repeated rows with that id one stays, whichever. Long texts are
    compared by digest and then by their full bytes.
    """
    ship_packages(spark)
    return exact.without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar texts keep the one with the smallest id.

    Texts of under five words are similar only to equal ones. Rows with a null id stay. Repeated rows of one id, which
    the stage before has left out, would stay together. Long texts are sketched and aligned whole.
    """
    ship_packages(spark)
    return omh.without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat, cut or leave out documents so that the sources reach their target weights.

    A null source is a source of its own. Texts without words are left out. Documents with equal finish times go by a
    hash of their id; repeated rows share what is taken of them. A long document may be cut at its end.
    """
    ship_packages(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 tokens.

    Empty texts are one token. Documents of over 1024 tokens are cut into full windows first. Repeated rows, of which the
    mix has many, are packed one by one; only the columns named by the packing contract are returned.
    """
    ship_packages(spark)
    packed = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.withColumn("length", F.col("length").cast("long"))


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mix_sources", mix_sources), ("pack_sequences", pack_sequences)]

#: Byte-pair tokens and order sketches are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
