"""Pipelines and the driver-table query catalog."""
