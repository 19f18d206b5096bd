"""Readers, normalising loaders and the table store."""
