"""Compositions of the operators into the reference workloads, and the query catalog."""
