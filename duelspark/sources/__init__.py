"""Readers, sinks and table storage."""
