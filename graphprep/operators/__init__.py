"""DataFrame operators. Nothing here writes; a few run a small statistics job to choose a plan."""
