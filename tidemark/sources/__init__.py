"""Raw files, lake tables, exports and shared scratch space."""
