"""Column functions: text views, phonetic codes, similarities."""
