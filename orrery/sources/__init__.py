"""Readers and writers (IO1-IO15)."""
