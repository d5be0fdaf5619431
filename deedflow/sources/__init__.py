"""Table declarations and where their rows come from."""
