"""Training-data operators: secrets, near and exact dedup, formatting, mixing, packing, quality and toxicity."""
