"""The jobs, as ``DataFrame -> DataFrame`` functions."""
