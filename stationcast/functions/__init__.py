"""Column expressions: units, times, names.  No actions, no Python UDFs."""
