"""Numpy kernels for single images, and their DataFrame wrappers."""
