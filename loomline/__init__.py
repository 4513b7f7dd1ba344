"""Spark-native production and machine-effectiveness tables for a weaving mill.

Layers: raw string tables -> typed silver tables -> gold facts and dimensions
-> measures and quality checks. Every step is a function from DataFrames to a
DataFrame; nothing runs until the caller writes or collects the result.
"""
