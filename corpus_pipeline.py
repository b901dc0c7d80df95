"""The corpus pipeline: five stages over `documents`, each written and read again.

Language ID drops rows in no learned language; SimHash keeps one row per group
of near copies; decontamination drops rows that contain a benchmark item; the
secret scan replaces secrets; mixing gives `repeats`, how often a row
stands in the mix, and leaves out rows it takes no time (`_repeats` and so on where the
documents have a column of that name). Clean rows pass every
filtering stage. All but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlab.llm import decontam, langid, mixing, secrets, simhash
from cohortlab.llm.queries import language_samples
from cohortlab.llm.ship import ship_package
from cohortlab.llm.tables import free_names
from cohortlab.session import ensure_checkpoint_dir, scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return langid.keep_identified(docs, language_samples(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.keep_one_per_group(docs, width=3, max_distance=2)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs)
    own, repeats = mixed.columns[:len(docs.columns)], mixed.columns[-1]
    taken = mixed.where(F.col(repeats) > 0)
    return taken.select(*[F.col(f"`{c}`") for c in own], F.col(repeats).alias(free_names(docs, "repeats")[0]))


STAGES = [("language_id", identify_language), ("simhash_dedup", drop_near_copies),
          ("decontaminate", drop_benchmark), ("secret_scan", redact_secrets), ("mix_sources", mix_sources)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Stages meet as Parquet under the session's shared folder."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
