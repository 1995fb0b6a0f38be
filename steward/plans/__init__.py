"""Whole jobs: synthetic scenarios and the file-to-table load."""
