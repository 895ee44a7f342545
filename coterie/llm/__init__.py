"""Operators for building training data from a table of documents, and their registered queries."""
