"""Millrace: MLOps data engine written as Spark DataFrame operators."""
