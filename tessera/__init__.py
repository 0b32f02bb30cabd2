"""tessera: tabular modelling pipelines (load, clean, encode, split, fit,
evaluate, rank, blend, write) as PySpark DataFrame plans and pyspark.ml fits.

Sub-packages: ``sources`` (read/write), ``functions`` (column expressions),
``operators`` (DataFrame -> DataFrame steps and the distributed order /
quantile primitives), ``models`` (estimators, scoring, searches), ``plans``
(the query catalogue with its SQL oracles), and the optional ``llm``
(operators for training-data pipelines), which nothing here imports.
"""

__version__ = "0.1.0"
