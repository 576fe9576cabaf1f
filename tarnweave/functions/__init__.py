"""Functions of tarnweave."""
