"""Sinks: sound files, scene documents and indices."""
