"""DataFrame -> DataFrame operators, usable unchanged in batch and in micro-batches."""
