"""Readers of files, saved runs and vector arrays."""
