"""Readers, writers and table folders."""
