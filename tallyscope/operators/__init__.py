"""The estimation pipeline, one module per stage."""
