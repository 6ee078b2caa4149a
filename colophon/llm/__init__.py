"""Training-data operators: deduplication, decontamination, privacy, packing, scoring and extraction."""
