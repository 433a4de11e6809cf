"""Training-data operators: dedup, quality, language, PII, licences, chat, tokens, packing."""
