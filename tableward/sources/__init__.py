"""Manifest, readers and sinks over any Hadoop-compatible file system."""
