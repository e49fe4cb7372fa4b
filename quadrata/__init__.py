"""Spark DataFrame operators for territorial panels: cleaning, aggregation, star schema, quality and statistics."""
