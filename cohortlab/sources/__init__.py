"""Sources and sinks: patient files in, prediction files out, and the test fixture."""

from cohortlab.sources.files import load_train_test, read_patients
from cohortlab.sources.sink import write_predictions

__all__ = ["load_train_test", "read_patients", "write_predictions"]
