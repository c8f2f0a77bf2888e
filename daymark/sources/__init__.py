"""Readers and writers: visit records, weather payloads, predictions, run tables."""
