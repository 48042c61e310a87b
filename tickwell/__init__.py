"""Market-data lake analytics expressed as PySpark DataFrame operators."""
