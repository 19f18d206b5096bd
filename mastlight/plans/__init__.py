"""The query catalogue, composed from operators and functions."""
