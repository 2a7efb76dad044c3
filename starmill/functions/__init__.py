"""Column expressions: clock decoding, text clean-up and derived measures."""
