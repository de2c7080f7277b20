"""Readers, writers and derived fixtures."""
