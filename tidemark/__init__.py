"""Tidemark: a PySpark market-data lakehouse (bronze payloads -> silver tables -> gold marts)."""
