"""Readers, writers and the binding of stored tables to the comment schema."""
