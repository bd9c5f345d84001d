"""Column expressions: text, vectors, quantization."""
