"""Readers, manifests and writers."""
