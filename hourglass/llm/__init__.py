"""Training-data operators (quality, deduplication, decontamination, tokens, web archives)."""
