"""Readers for flat, fixed-width, XML and document files, and the catalog scan."""
