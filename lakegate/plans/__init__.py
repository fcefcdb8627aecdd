"""Whole jobs: build and publish a snapshot, replay one, serve the published one."""
