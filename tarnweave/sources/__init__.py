"""Sources of tarnweave."""
