"""Readers, bulk extraction and writers."""
