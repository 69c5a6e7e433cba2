"""Readers and writers of the text and record formats."""
