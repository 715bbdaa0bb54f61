"""Inputs: parameter files, synthetic visibilities, heap directories, attributes."""
