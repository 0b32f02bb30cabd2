"""Estimators through pyspark.ml with sklearn parameter conventions
(linear, trees, boosting), closed-form models (Gaussian NB, exact kNN),
scoring, and cross-validation / search loops."""
