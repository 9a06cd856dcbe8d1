"""candlewick: time-ordered, per-entity analytics as Spark DataFrame operators."""
