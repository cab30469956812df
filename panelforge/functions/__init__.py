"""panelforge.functions."""
