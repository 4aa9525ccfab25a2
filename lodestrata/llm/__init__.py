"""Training-data operators: secrets, toxicity, deduplication, tokens, media, decontamination, sharding.

Nothing outside this subpackage imports it, and the rest of the library works without it.
"""
