"""The running connector: snapshot, stream, checkpoints, group, metrics."""
