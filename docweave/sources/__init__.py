"""Readers, writers and the views that give test tables the shape of the stored ones."""
