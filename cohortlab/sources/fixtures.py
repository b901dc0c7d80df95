"""Patient stand-in computed from the driver's ``events`` table.

The original application ships no data, and the driver tables hold no nulls and no signal,
so the patient table is derived from ``events`` with injected nulls, a ``Yes``
case trap, rare flags and a learnable label. Each column is one portable SQL
expression that Spark and DuckDB evaluate identically, so the same text feeds
the Spark fixture and the DuckDB oracles. ``event_id`` is unique and
non-negative; ``(id * a) % m`` is written ``((id % m) * a) % m``, which is the
same value and cannot overflow at any table size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.functions.keys import hash_mod
from cohortlab.schema import ID, LABEL


def _h(mult: int, mod: int, col: str = "event_id") -> str:
    return f"((({col} % {mod}) * {mult}) % {mod})"


def _d(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


# (column, SQL expression over events) in file order.
PATIENT_EXPRESSIONS: tuple[tuple[str, str], ...] = (
    (ID, "event_id"),
    ("age", f"CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(32 + {_h(7919, 39)} AS INT) END"),
    ("education", f"CASE WHEN event_id % 23 = 0 THEN NULL ELSE {_d('1 + ' + _h(104729, 4))} END"),
    ("sex", f"CASE WHEN event_id % 29 = 0 THEN NULL WHEN {_h(1299709, 100)} < 43 THEN 'M' ELSE 'F' END"),
    ("is_smoking", "CASE WHEN event_type IN ('click', 'view') THEN 'YES' "
                   "WHEN event_type = 'error' THEN 'Yes' ELSE 'NO' END"),
    ("cigsPerDay", f"CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_type IN ('click', 'view') "
                   f"THEN {_d('1 + ' + _h(15485863, 40))} ELSE {_d('0')} END"),
    ("BPMeds", f"CASE WHEN event_id % 41 = 0 THEN NULL WHEN {_h(32452843, 100)} < 3 "
               f"THEN {_d('1')} ELSE {_d('0')} END"),
    ("prevalentStroke", f"CASE WHEN {_h(49979687, 200)} < 1 THEN 1 ELSE 0 END"),
    ("prevalentHyp", f"CASE WHEN {_h(67867967, 100)} < 31 THEN 1 ELSE 0 END"),
    ("diabetes", f"CASE WHEN {_h(86028121, 100)} < 3 THEN 1 ELSE 0 END"),
    ("totChol", f"CASE WHEN event_id % 43 = 0 THEN NULL ELSE {_d('150 + user_id % 151')} END"),
    ("sysBP", _d(f"100 + {_h(122949823, 81)}")),
    ("diaBP", _d(f"60 + {_h(141650939, 41)}")),
    ("BMI", f"CASE WHEN event_id % 47 = 0 THEN NULL WHEN value > 60 THEN {_d('36')} "
            f"ELSE {_d('18')} + value * {_d('0.3')} END"),
    ("heartRate", f"CASE WHEN event_id % 997 = 0 THEN NULL ELSE {_d('50 + ' + _h(160481183, 61))} END"),
    ("glucose", f"CASE WHEN event_id % 11 = 0 THEN NULL ELSE {_d('60 + ' + _h(179424673, 91))} END"),
    (LABEL, f"CASE WHEN 2 * {_h(7919, 39)} + {_h(122949823, 81)} + {_h(141650939, 41)} "
            f"+ {_h(179424691, 40)} > 140 THEN 1 ELSE 0 END"),
)

# Layout-independent key-hash split of the patients into the training file and
# the file to score (unlike randomSplit, whose rows change with the partition count).
TRAIN_EXPR = f"{_h(7919, 1009, ID)} < 706"


def train_flag(id_col: str = ID) -> Column:
    return hash_mod(id_col, 7919, 1009) < F.lit(706)


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All patients (train and scored rows, label included), one row per event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(*[F.expr(e).alias(n) for n, e in PATIENT_EXPRESSIONS])


def train_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training file: about 70% of the patients, chosen by key hash."""
    return patients(spark, sf_dir).filter(train_flag())


def scored_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file to score: the other rows, without the label."""
    return patients(spark, sf_dir).filter(~train_flag()).drop(LABEL)


def patients_sql() -> str:
    """The same patient table as a DuckDB/ANSI select over ``events``."""
    cols = ",\n  ".join(f'{e} AS "{n}"' for n, e in PATIENT_EXPRESSIONS)
    return f"SELECT\n  {cols}\nFROM events"
