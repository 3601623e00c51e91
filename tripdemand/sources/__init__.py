"""Readers and writers: trip files, zone lookup, borough polygons, streams, tables."""
