"""Operators for preparing training data: one module each, over tables of documents, pages or conversations."""
