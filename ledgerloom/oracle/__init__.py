"""Plain SQL for each key, run on the same tables by another engine."""
