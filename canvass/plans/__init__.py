"""Reports composed from operators. Every function takes an ``Election``
bundle and returns a lazy DataFrame."""
