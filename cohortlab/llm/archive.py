"""Web pages to a de-duplicated WARC archive and back, with the `warc` data source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlab.llm.tables import written
from cohortlab.llm.warc import WarcDataSource

LEAST_REVISIT = 100   #: bytes from which an equal payload becomes a revisit
_PREFIX, _DATE = "urn:x-page:", "1970-01-01T00:00:00Z"


def use_warc(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def page_records(pages: DataFrame, least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """The records of `pages` (page_id, url, html), as the data source writes them.

    Payloads (null html: empty) are compared by length and SHA-256. Only the
    payloads that occur more than once, a row each, meet the pages in a join: that table
    is written first, so that Spark knows its size when it chooses between a
    broadcast and a shuffle (whose hot payloads it splits). A page without an id has an empty one and
    responds unless an equal payload has an id; rows that repeat the responding id all respond.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    shared = (rows.where(F.col("payload_bytes") >= least_revisit).groupBy("digest")
              .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n"))
    joined = rows.join(written(shared, "shared-payloads"), "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    urn = lambda c: F.concat(F.lit(f"<{_PREFIX}"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), urn("page_id").alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(_DATE).alias("warc_date"),
        F.when(revisit, urn("first_id")).alias("refers_to"), F.col("digest").alias("payload_digest"),
        F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes")


def write_archive(pages: DataFrame, path: str) -> None:
    """One archive file per partition; no file for an empty partition."""
    use_warc(pages.sparkSession)
    page_records(pages).write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(`page_id`, `payload_bytes`, `payload_digest`, `record_type`, `refers_to`) per page record.

    Responses are measured on the payload that was read. Revisits are read by a
    scan of their own, which skips every payload.
    """
    use_warc(spark)
    page = lambda c: F.regexp_extract(c, f"{_PREFIX}(-?[0-9]+)>", 1).try_cast("bigint")
    files = lambda **o: spark.read.format("warc").options(**o).load(path)
    responses = files(payload="response").where("record_type = 'response'").select(
        page(F.col("record_id")).alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast("bigint").alias("refers_to"))
    revisits = files(payload="none").where("record_type = 'revisit'").select(
        page(F.col("record_id")).alias("page_id"), F.col("http_length").alias("payload_bytes"),
        F.regexp_extract("payload_digest", "sha256:(.*)", 1).alias("payload_digest"), "record_type",
        page(F.col("refers_to")).alias("refers_to"))
    return responses.unionByName(revisits)
