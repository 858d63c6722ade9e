"""Report steps, run and job analytics, join helpers."""
