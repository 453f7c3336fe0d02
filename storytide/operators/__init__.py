"""DataFrame to DataFrame steps that the plans are composed of."""
