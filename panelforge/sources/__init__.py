"""panelforge.sources."""
