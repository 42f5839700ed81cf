"""Set-oriented operators of the linkage task."""
