"""Readers for corpora and word lists, and text writers."""
