"""Readers, writers and versioned collections."""
