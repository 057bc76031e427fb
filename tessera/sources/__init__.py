"""Readers, writers and downloads."""
