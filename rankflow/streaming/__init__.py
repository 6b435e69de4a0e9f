"""Jobs over a log that keeps growing."""
