"""panelforge.streaming."""
