"""Training-data operators: quality, decontamination, dedup, archives, tokenizers."""
