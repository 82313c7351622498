"""Record linkage and co-occurrence analytics as Spark table jobs."""
