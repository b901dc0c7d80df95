import glob
import os

import pytest
from pyspark.errors import AnalysisException

from cohortlab.schema import EXPORT_COLUMNS, PATIENT_SCHEMA
from cohortlab.sources.files import load_train_test, read_patients
from cohortlab.sources.fixtures import train_patients
from cohortlab.sources.sink import write_predictions
from conftest import SF_SMALL


def write_csv(df, path):
    df.write.option("header", True).csv(path)


def test_csv_inferred_and_explicit_schema(spark, tmp_out):
    raw = train_patients(spark, SF_SMALL)
    path = os.path.join(tmp_out, "train")
    write_csv(raw, path)
    inferred = read_patients(spark, path)
    assert dict(inferred.dtypes)["sex"] == "string" and dict(inferred.dtypes)["BMI"] == "double"
    assert inferred.count() == raw.count()
    explicit = read_patients(spark, path, schema=PATIENT_SCHEMA)
    assert explicit.schema == PATIENT_SCHEMA
    assert explicit.exceptAll(raw).count() == 0                   # empty field -> null
    tr, te = load_train_test(spark, path, path, schema=PATIENT_SCHEMA)
    assert tr.schema == te.schema


def test_empty_field_is_null_and_na_text_is_string(spark, tmp_out):
    p = os.path.join(tmp_out, "f.csv")
    with open(p, "w") as f:
        f.write("id,a,b\n1,,NA\n2,3,4\n")
    df = read_patients(spark, p)
    assert dict(df.dtypes)["b"] == "string"
    assert df.orderBy("id").first().a is None


def _two_column_file(tmp_out, name, header, *lines):
    p = os.path.join(tmp_out, name)
    with open(p, "w") as f:
        f.write("\n".join([header, *lines]) + "\n")
    return p


TWO = "sysBP double, diaBP double"


def test_explicit_schema_is_checked(spark, tmp_out):
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(TWO)
    good = _two_column_file(tmp_out, "good.csv", "sysBP,diaBP", "140.5,80", ",90")
    assert [tuple(r) for r in read_patients(spark, good, schema=schema).collect()] == [(140.5, 80.0), (None, 90.0)]
    for name, header, line in (("swapped", "diaBP,sysBP", "80,140"), ("lacking", "sysBP", "140"),
                               ("text", "sysBP,diaBP", "NA,80")):
        path = _two_column_file(tmp_out, f"{name}.csv", header, line)
        with pytest.raises(Exception):
            read_patients(spark, path, schema=schema).collect()
    parquet = os.path.join(tmp_out, "pq")
    spark.createDataFrame([(1.0,)], "sysBP double").write.parquet(parquet)
    with pytest.raises(ValueError, match="diaBP"):
        read_patients(spark, parquet, "parquet", schema)


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from cohortlab.session import ensure_checkpoint_dir

    def session(master, folder=None):
        made = []
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None,
                             setCheckpointDir=made.append)
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: folder))
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1000]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(session(master))
        assert ensure_checkpoint_dir(session(master, "hdfs://x/shared")) == "hdfs://x/shared"
    assert ensure_checkpoint_dir(session("local[4]"))


def _scored(spark):
    from cohortlab.queries import rule_prediction, prepared_scored
    return rule_prediction(prepared_scored(spark, SF_SMALL))


def test_sink_roundtrip_and_exists_error(spark, tmp_out):
    scored = _scored(spark)
    out = os.path.join(tmp_out, "pred")
    write_predictions(scored, out)
    back = read_patients(spark, out, schema=scored.select(*EXPORT_COLUMNS).schema)
    assert back.columns == list(EXPORT_COLUMNS)
    assert back.exceptAll(scored.select(*EXPORT_COLUMNS)).count() == 0
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS|already exists"):
        write_predictions(scored, out)


def test_single_file_output(spark, tmp_out):
    out = os.path.join(tmp_out, "one")
    write_predictions(_scored(spark).repartition(5), out, single_file=True)
    assert len(glob.glob(os.path.join(out, "part-*.csv"))) == 1
