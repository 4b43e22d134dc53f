"""Readers, writers and catalog discovery."""
