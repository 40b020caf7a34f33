"""Column functions: decoding, text helpers and path extraction."""
