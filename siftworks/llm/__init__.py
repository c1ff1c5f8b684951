"""Operators for training-data pipelines over the tables of documents, pages and conversations."""
