"""Patient table layout: feature order, keys, label and the explicit schema."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the original application's for equal results.
# Model feature order, identifier, label, prediction column, the six
# exploration keys, the two encoded categoricals with the single value that
# maps to 1, their decoded labels, and the series / column names of its reports.
FEATURES = (
    "age", "education", "sex", "is_smoking", "cigsPerDay", "BPMeds",
    "prevalentStroke", "prevalentHyp", "diabetes", "totChol", "sysBP", "diaBP",
    "BMI", "heartRate", "glucose",
)
ID = "id"
LABEL = "TenYearCHD"
PREDICTION = "prediction"
EXPLORE_KEYS = ("age", "sex", "is_smoking", "heartRate", "cigsPerDay", "BPMeds")
SEX_POSITIVE = "M"
SMOKING_POSITIVE = "YES"
SEX_LABELS = ("M", "F")            # decoded 1 / anything else
SMOKING_LABELS = ("YES", "NO")
TARGET_SERIES = ("TenYearCHD", "Non TenYearCHD")
PREDICTION_SERIES = ("Prediction_1", "Prediction_0")
MISSING_SERIES = ("Missing Data", "Missing Data (After)")
GENDER_LABEL = "GenderLabel"
TOTAL, PREDICTION_ONE, PREDICTION_ZERO, PREDICTION_COUNT = "Total", "prediction_1", "prediction_0", "prediction_count"
# ---------------------------------------------------------------------------

# Columns of the exported prediction file: id, the features, the prediction.
EXPORT_COLUMNS = (ID, *FEATURES, PREDICTION)

# Explicit schema for the patient files. Reading with it avoids the extra
# inference pass over the whole input and keeps train and test types equal.
PATIENT_SCHEMA = T.StructType([
    T.StructField(ID, T.LongType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("education", T.DoubleType()),
    T.StructField("sex", T.StringType()),
    T.StructField("is_smoking", T.StringType()),
    T.StructField("cigsPerDay", T.DoubleType()),
    T.StructField("BPMeds", T.DoubleType()),
    T.StructField("prevalentStroke", T.IntegerType()),
    T.StructField("prevalentHyp", T.IntegerType()),
    T.StructField("diabetes", T.IntegerType()),
    T.StructField("totChol", T.DoubleType()),
    T.StructField("sysBP", T.DoubleType()),
    T.StructField("diaBP", T.DoubleType()),
    T.StructField("BMI", T.DoubleType()),
    T.StructField("heartRate", T.DoubleType()),
    T.StructField("glucose", T.DoubleType()),
    T.StructField(LABEL, T.IntegerType()),
])

# The scored file may lack the label.
SCORED_SCHEMA = T.StructType([f for f in PATIENT_SCHEMA.fields if f.name != LABEL])
