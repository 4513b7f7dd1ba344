"""The incremental status load as micro-batches, an option beside the daily run."""
