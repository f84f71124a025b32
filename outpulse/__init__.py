"""Send-performance analytics expressed as Spark DataFrame operators."""
