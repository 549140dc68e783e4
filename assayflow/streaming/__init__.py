"""Landed files as a stream: into raw, and on into merged tables."""
