"""Streaming of tarnweave."""
