"""Feature, data-quality and drift analytics for time-ordered Spark tables."""
