"""The jobs, one module per case study."""
