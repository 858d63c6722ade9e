"""Whole-report plans: the plain run, the tuned run, timing."""
