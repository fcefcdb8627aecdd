"""Schemas and specs: the mobility feeds, and the driver's tables seen as those feeds."""
