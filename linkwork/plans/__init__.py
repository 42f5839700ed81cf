"""The linkage pipeline as one plan."""
