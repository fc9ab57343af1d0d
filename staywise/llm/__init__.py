"""Operators for building training corpora: archives, chat rendering, deduplication, scans, quality and mixing."""
