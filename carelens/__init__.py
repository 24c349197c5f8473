"""Data quality and characterization of clinical tables, written as Spark DataFrame operators."""
