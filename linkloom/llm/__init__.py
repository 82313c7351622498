"""Training-data operators: de-duplication, quality, tokens, archives, packing."""
