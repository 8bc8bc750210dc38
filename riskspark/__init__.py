"""riskspark: transaction-risk analytics as Spark DataFrame, SQL, ML and
Structured Streaming jobs.

Sub-packages:

- ``sources``   — readers, sinks and the tables derived from the driver data
- ``functions`` — column expressions (scalar functions)
- ``operators`` — cleaning, validation, metrics, drift, preparation, models,
                  explanations, registry
- ``plans``     — the registered queries and their SQL oracles, plus the
                  training and monitoring flows
- ``streaming`` — Structured Streaming jobs
"""

from riskspark.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
