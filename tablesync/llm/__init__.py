"""Operators for building training data from documents, pages, embeddings and conversations."""
