"""tidemark: periodic-snapshot marts as Spark DataFrame operators."""
