"""footfall: Spark-native point-in-time forecasting features, data profiling,
deterministic splits, model selection and evaluation tables.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, so Catalyst plans, prunes and pushes down the whole job.
"""

__version__ = "0.1.0"
