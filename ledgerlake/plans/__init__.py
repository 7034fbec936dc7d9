"""End-to-end jobs: bronze load, silver build, label dimension, gold marts."""
