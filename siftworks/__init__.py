"""Curation of text records from many sources, as Spark plans."""
