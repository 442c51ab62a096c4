"""Independent SQL for every query, to compare results with another engine."""
