"""Training-data operators: decontamination, extraction, deduplication, scans, mixing, scoring, sharding, search."""
