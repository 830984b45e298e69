"""Readers and writers: files, message topics, change feeds, external queries."""
