"""Restartable and windowed streaming jobs."""
