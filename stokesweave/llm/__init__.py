"""Text operators for training corpora: extraction, packing, scans, deduplication, encoding, scoring, search."""
