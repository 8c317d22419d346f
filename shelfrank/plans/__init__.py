"""Jobs and serving queries composed from operators."""
