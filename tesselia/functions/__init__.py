"""Column expressions: text and metadata parsing, frame and patch geometry, pyramid levels, pixels."""
