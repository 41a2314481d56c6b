"""DataFrame operators: de-duplication, labelling, upsert, rejects, top-n."""
