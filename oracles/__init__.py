"""Independent SQL for the checks, by family."""
