"""Readers and writers for logs, feature sets and fitted artifacts."""
