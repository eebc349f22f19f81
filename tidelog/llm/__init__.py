"""Training-data operators: toxicity, near-duplicates, secrets, mixing, packing, PII, quality, chat.

Nothing outside this subpackage imports it.
"""
