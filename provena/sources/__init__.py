"""Readers and connectors. Network and model clients are injected; the default one opens only file: addresses."""
