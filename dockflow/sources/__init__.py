"""Readers, sinks, explicit schemas and the adapters for the supplied test tables."""
