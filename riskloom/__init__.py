"""Address-risk features, scoring and drift as Spark jobs."""
