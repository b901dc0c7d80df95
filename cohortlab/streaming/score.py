"""Score patient files as they arrive, with a fitted model and fixed medians.

A stream has no exact median of its own (it is unbounded), so the fill uses
medians fitted on a training file. Every step is stateless (encode, fill, the
folded linear score, projection), so each micro-batch is scored
independently; the file sink plus the checkpoint give exactly-once output.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cohortlab.operators.encode import encode_categoricals
from cohortlab.operators.impute import apply_medians
from cohortlab.operators.model import linear_model, with_linear_score
from cohortlab.schema import FEATURES, SCORED_SCHEMA
from cohortlab.sources.files import STRICT_CSV, select_columns
from cohortlab.sources.sink import export_projection

ENCODED = ("sex", "is_smoking")   # encoding leaves no gap in them


def score_stream(spark: SparkSession, model, medians: dict[str, float], source_dir: str,
                 out_dir: str, checkpoint_dir: str, schema: T.StructType = SCORED_SCHEMA,
                 fmt: str = "csv", available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the query; ``max_files_per_trigger`` bounds each micro-batch.

    ``medians`` must have every model column (``Prepared.medians_for_other()``):
    a stream's gaps are not known beforehand. CSV files are checked against the
    schema one by one. Of a Parquet source the columns of the files present at
    the start are checked; a later file without one reads it as null.
    """
    lacking = [c for c in FEATURES if c not in medians and c not in ENCODED]
    if lacking:
        raise ValueError(f"no median for the column(s) {lacking}; fit them with medians_for_other()")
    if fmt == "parquet":
        select_columns(spark.read.parquet(source_dir), schema)
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.options(**STRICT_CSV)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.option("header", True).csv(source_dir) if fmt == "csv" else reader.parquet(source_dir)
    scored = with_linear_score(apply_medians(encode_categoricals(stream), medians), linear_model(model))
    writer = (export_projection(scored).writeStream.format(fmt)
              .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    if fmt == "csv":
        writer = writer.option("header", True)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(out_dir)
