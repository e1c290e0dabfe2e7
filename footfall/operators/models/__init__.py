"""Estimators: thin, Spark-ML-first wrappers plus the few models Spark ML
lacks (Gaussian naive Bayes with variance smoothing, random Fourier
features, stacking, recursive feature elimination)."""
