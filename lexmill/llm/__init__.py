"""Operators for building training corpora: documents in, documents or judgements out."""
