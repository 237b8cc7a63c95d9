"""DataFrame-to-DataFrame operators of the analysis."""
