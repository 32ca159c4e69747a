"""Training-data operators: dedup, fixity, mixing, quality, language, toxicity, PII, packing, secrets."""
