"""tidemark: incremental document analytics as PySpark DataFrame operators."""
