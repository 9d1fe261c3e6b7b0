"""Readers and writers: record pages, CSV batches, dataset exports, catalog tables."""
