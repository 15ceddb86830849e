"""Logs from tables and files, and payload decoding."""
