"""Pixel kernels in numpy."""
