"""Readers: tagged collections, stop lists, topics, judgements, index tables."""
