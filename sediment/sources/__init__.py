"""Readers, writers, keyed merge and file manifests."""
