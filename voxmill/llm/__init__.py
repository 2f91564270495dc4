"""Operators for preparing text corpora: filters, deduplication, decontamination, token files."""
