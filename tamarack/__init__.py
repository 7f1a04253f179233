"""Tamarack: a DataFrame-first text-analytics engine on Spark."""
