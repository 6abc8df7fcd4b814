"""Readers, landing, gate and sinks."""
