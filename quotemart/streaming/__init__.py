"""The daily load as a stream over landing files."""
