"""Configuration, orchestration and the command line."""
