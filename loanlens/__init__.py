"""Loan default-risk analytics on Spark DataFrames.

Sub-packages: ``sources`` (scans, sinks, export profiles, test fixture),
``functions`` (column expressions), ``operators`` (ETL, profiling,
segmentation, folds, AUC, models), ``plans`` (pipeline and registered
queries) and ``streaming`` (incremental ETL over a file stream).
"""

__version__ = "0.1.0"
