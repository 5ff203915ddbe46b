"""Landing, files, catalog tables."""
