"""Load decisions for many tables, and the whole load job."""
