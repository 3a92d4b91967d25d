"""Operators over text corpora: web pages, documents, embeddings and conversations."""
