"""Readers, writers and the file-backed stores."""
