"""Categorical encoding in place (sex, is_smoking)."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortlab.functions.encode import encode_sex, encode_smoking


def encode_categoricals(df: DataFrame) -> DataFrame:
    """``sex``: M -> 1, else 0; ``is_smoking``: YES -> 1, else 0 (null -> 0). One projection.

    Only text columns are encoded; a numeric column is taken as already
    encoded and kept, so preparing a prepared frame changes nothing.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = {}
    if isinstance(types.get("sex"), T.StringType):
        cols["sex"] = encode_sex("sex")
    if isinstance(types.get("is_smoking"), T.StringType):
        cols["is_smoking"] = encode_smoking("is_smoking")
    return df.withColumns(cols) if cols else df
