"""Reports and planning rules composed of operators."""
