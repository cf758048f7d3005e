"""DataFrame -> DataFrame operators of the reporting pipeline."""
