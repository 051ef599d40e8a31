"""Revenue and matchup analytics expressed as Spark DataFrame operators."""
