"""Plans: the batch pipeline (clean / aggregate) and the query catalogue."""
