"""Named data products composed from operators."""
