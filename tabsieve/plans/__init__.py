"""Bindings of the operators to the benchmark tables, and the query catalog."""
