"""Quarterdeck: DataFrame -> DataFrame operators for layered time-series tables."""

__version__ = "0.1.0"
