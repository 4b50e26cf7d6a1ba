"""Column expressions: no state, no actions, no Python UDFs."""
