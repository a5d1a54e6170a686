"""Training-data operators: mixing, deduplication, decontamination, tokens, search."""
