"""Compositions of the operators: the layered flow, SQL twins and the query catalogue."""
