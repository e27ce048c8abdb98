"""Text operators: tokenization, packing of texts into windows, sentence units. Nothing outside this package imports it."""
