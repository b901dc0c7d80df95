"""Compositions of operators: the prepare step and the whole batch job."""

from cohortlab.plans.prepare import Prepared, prepare

__all__ = ["Prepared", "prepare"]
