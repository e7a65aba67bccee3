"""Row operators: envelope, normalisation, keyed merge, key maps."""
