"""Column functions: text, markup, selection, content, URLs."""
