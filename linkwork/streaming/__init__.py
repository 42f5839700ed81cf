"""The linkage task has no stream source, sink or operator: batch only."""
