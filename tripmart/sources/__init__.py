"""Landed files, raw capture and the table folder with its commit log."""
