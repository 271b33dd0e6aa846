"""Readers, written tables and the published star."""
