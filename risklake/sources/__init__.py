"""Reading and writing: raw files, layers, incremental loads, exports."""
