"""Trustworthy table snapshots on Spark: contracts, quarantine, marts, drift, gates and replay."""

__version__ = "0.1.0"
