"""DataFrame operators: feature families, profiling, encoding, splits,
metrics and model helpers.  Each is ``(DataFrame, ...) -> DataFrame``."""
