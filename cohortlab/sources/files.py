"""Patient file scans (CSV with a header, or Parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_patients(spark: SparkSession, path: str, fmt: str = "csv",
                  schema: T.StructType | None = None) -> DataFrame:
    """Scan one patient file.

    CSV is read with a header; empty fields become null. Without ``schema`` the
    types are inferred from the file (one extra pass over the data, and two
    files can come out with different types for the same column); with
    ``schema`` there is no inference pass, each file's header must name the schema's
    columns in order, and a value that is not of its column's type (``NA`` in a
    number) is an error, not a null. Parquet carries its own schema; with
    ``schema`` a column that the files lack is an error.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return select_columns(df, schema) if schema is not None else df
    if fmt != "csv":
        raise ValueError(f"unsupported patient file format: {fmt!r}")
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.options(**STRICT_CSV).schema(schema).csv(path)


#: With an explicit schema: check each header against it, fail on a malformed row.
STRICT_CSV = {"enforceSchema": "false", "mode": "FAILFAST"}


def select_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns of ``df``; a lacking one is an error."""
    lacking = [f.name for f in schema.fields if f.name not in df.columns]
    if lacking:
        raise ValueError(f"the files lack the column(s) {lacking}")
    return df.select(*[f.name for f in schema.fields])


#: Inferred types from narrow to wide; two types that are not both here meet as text.
WIDER = (T.IntegerType(), T.LongType(), T.DoubleType())


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if a == b:
        return a
    if a in WIDER and b in WIDER:
        return max(a, b, key=WIDER.index)
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def joint_schemas(a: DataFrame, b: DataFrame) -> tuple[T.StructType, T.StructType]:
    """The schemas of two inferred files with one type per common column.

    Types widen column by column (int, bigint, double; else string). A column
    that is empty in one file is inferred as text there and says nothing: where the other
    file has another type, one count over such columns alone tells.
    """
    types = [{f.name: f.dataType for f in df.schema.fields} for df in (a, b)]
    common = [c for c in types[0] if c in types[1]]
    for mine, other, df in ((types[0], types[1], a), (types[1], types[0], b)):
        doubt = [c for c in common if isinstance(mine[c], T.StringType) and mine[c] != other[c]]
        if doubt:
            counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(doubt)]).first()
            mine.update({c: other[c] for i, c in enumerate(doubt) if counts[i] == 0})
    for c in common:
        types[0][c] = types[1][c] = wider_type(types[0][c], types[1][c])
    return tuple(T.StructType([T.StructField(c, t) for c, t in mine.items()]) for mine in types)


def load_train_test(spark: SparkSession, train_path: str, test_path: str,
                    fmt: str = "csv", schema: T.StructType | None = None,
                    test_schema: T.StructType | None = None, joint: bool = False) -> tuple[DataFrame, DataFrame]:
    """The training file and the file to score, each scanned independently.

    ``joint`` infers both, then reads both with one type per common column, so that a
    column of whole numbers in one file and fractions in the other is double
    in both; a value that does not fit is an error. Without it each file keeps the types
    of its own inference, as the original does. Given schemas are not changed.
    """
    train = read_patients(spark, train_path, fmt, schema)
    test = read_patients(spark, test_path, fmt, test_schema if test_schema is not None else schema)
    if joint and schema is None and test_schema is None:
        schemas = joint_schemas(train, test)
        if fmt == "csv":
            return tuple(read_patients(spark, p, fmt, s) for p, s in zip((train_path, test_path), schemas))
        return tuple(df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in s.fields])
                     for df, s in zip((train, test), schemas))
    return train, test
