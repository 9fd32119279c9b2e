"""Column-parametrised DataFrame steps."""
