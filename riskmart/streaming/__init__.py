"""The monthly load as a file stream."""
