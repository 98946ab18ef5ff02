"""Cleaning chains and the bronze-silver-gold jobs."""
