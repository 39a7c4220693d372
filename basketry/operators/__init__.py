"""DataFrame -> DataFrame transforms; no input or output happens here."""
