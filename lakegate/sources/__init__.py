"""Feeds, file manifests and the snapshot store."""
