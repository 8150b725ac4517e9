"""Column expressions: text, vectors, stems."""
