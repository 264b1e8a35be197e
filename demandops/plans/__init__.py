"""Stage composition and the registered query catalogue."""
