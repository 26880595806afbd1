"""Inputs: files, generated rows and the clickstream views of the given tables."""
