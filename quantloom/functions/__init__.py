"""Column functions: prices, returns, indicators, dates and bins."""
