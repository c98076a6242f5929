"""Column expressions (pure pyspark.sql.functions compositions)."""
