"""Training-data operators (fingerprints, language models, tokenisation, archives, filters)."""
