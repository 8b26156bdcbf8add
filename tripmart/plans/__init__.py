"""The trip models: staging, dimensions, fact, reports and the full build."""
