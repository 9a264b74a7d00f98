"""Compositions: pages to documents, documents to marts, marts to reports."""
