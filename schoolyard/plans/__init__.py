"""Layers of the model: clean, curated, report, and what is asked of them."""
