"""Stateful sampling of recordings as they come in."""
