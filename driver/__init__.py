"""The trip models run over the driver's test tables, with their SQL oracles."""
