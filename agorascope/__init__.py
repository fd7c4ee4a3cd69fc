"""Social-text analytics as PySpark DataFrame operators."""
