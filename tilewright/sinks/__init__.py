"""Where datasets and reports are written."""
