"""Readers of annotation exports, labels, recordings, images and file listings."""
