"""Readers: tables, day directories, zip archives, streams."""
