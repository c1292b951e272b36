"""Training-data operators: filtering, near-duplicate detection, tokenised output and packing."""
