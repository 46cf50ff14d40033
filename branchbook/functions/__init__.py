"""See package docstring."""
