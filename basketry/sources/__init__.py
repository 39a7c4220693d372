"""Reading and writing: raw files, layer tables, golden sets, reports."""
