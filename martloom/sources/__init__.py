"""Source registry, raw readers, table storage."""
