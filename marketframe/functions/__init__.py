"""Scalar column functions (F1–F16). Everything returns a Column built from pyspark built-ins."""
