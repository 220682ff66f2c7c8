"""Training-data operators: filtering, deduplication, decontamination, packing, scoring and archive formats."""
