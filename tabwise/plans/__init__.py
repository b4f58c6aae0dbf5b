"""Query catalogue over the driver tables: one plan per operator key."""
