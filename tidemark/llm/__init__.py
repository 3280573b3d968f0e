"""Training-data operators: language, near and exact duplicates, quality, mixing, tokens, leaks."""
