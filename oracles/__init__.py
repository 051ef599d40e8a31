"""Independent SQL for every deterministic query, runnable on the sample tables."""
