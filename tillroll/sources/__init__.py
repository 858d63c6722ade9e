"""Readers and writers: transactions, generated data, metrics, event logs."""
