"""Feature tables, reporting views, the liquidity model and the daily run."""
