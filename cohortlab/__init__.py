"""cohortlab: a PySpark pipeline for binary risk prediction on patient-style tables.

Every operator takes and returns a lazy ``DataFrame``; the only values that reach
the driver are bounded ones (per-column medians, metric rows, fitted coefficients).
"""

__version__ = "0.1.0"
