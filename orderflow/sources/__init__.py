"""Readers for files and streams."""
