"""Operators on training text: near duplicates, tokens, fingerprints, chat, quality, packing, toxicity, archives, spans, pages."""
