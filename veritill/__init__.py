"""Trust engine for retail transactions on Spark.

Raw exports go in; validated, cleaned, quarantined, de-duplicated and enriched tables come
out, together with the results of quality checks and anomaly detectors.  Every operator takes
and returns Spark DataFrames and stays lazy until a sink writes it.
"""

from veritill.plans.run import RunResult, run_pipeline

__all__ = ["RunResult", "run_pipeline"]
