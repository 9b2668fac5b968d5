"""Readers, table writes, and adapters that shape the driver's tables into chat inputs."""
