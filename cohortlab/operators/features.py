"""Feature vectors and their standardisation, also in long (oracle-checkable) form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.operators.model import assembler, scaler
from cohortlab.schema import FEATURES, ID


def _long(df: DataFrame, vec: str, features: Sequence[str], id_col: str, digits: int | None) -> DataFrame:
    names = F.array(*[F.lit(f) for f in features])
    out = (df.select(id_col, F.posexplode(vector_to_array(F.col(vec))).alias("pos", "value"))
           .select(id_col, F.element_at(names, F.col("pos") + 1).alias("feature"), "value"))
    return out.withColumn("value", F.round("value", digits)) if digits is not None else out


def assemble(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    return assembler(features).transform(df)


def feature_long(df: DataFrame, features: Sequence[str] = FEATURES, id_col: str = ID) -> DataFrame:
    """``id, feature, value``: the assembled vector, one row per element."""
    return _long(assemble(df, features), "features", features, id_col, None)


def standard_scale_long(df: DataFrame, features: Sequence[str] = FEATURES, id_col: str = ID,
                        digits: int = 6) -> DataFrame:
    """``id, feature, value``: (x - mean) / sample stddev, fitted on ``df`` (one aggregate)."""
    assembled = assemble(df, features)
    scaled = scaler().fit(assembled).transform(assembled)
    return _long(scaled, "scaledFeatures", features, id_col, digits)
