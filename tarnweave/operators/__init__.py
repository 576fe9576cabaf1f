"""Operators of tarnweave."""
