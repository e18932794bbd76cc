"""Payload scans, row extraction and sinks."""
