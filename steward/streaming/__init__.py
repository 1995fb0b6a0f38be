"""Operators over streams: windows with late rows kept apart (X1), double spends as they arrive."""
