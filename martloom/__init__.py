"""martloom: layered retail analytics (raw, cleaned, aggregated) as Spark jobs."""
