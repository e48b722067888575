"""Column functions: checkpoints, paths, Kafka values and event envelopes."""
