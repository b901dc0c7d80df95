"""Column-expression helpers (JVM-side ``pyspark.sql.functions`` only)."""

from cohortlab.functions.encode import encode_sex, encode_smoking, sex_label, smoking_label
from cohortlab.functions.keys import category_text, hash_mod, valid_number

__all__ = [
    "encode_sex", "encode_smoking", "sex_label", "smoking_label",
    "category_text", "hash_mod", "valid_number",
]
