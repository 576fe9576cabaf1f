"""Plans of tarnweave."""
