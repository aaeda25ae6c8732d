"""Compositions of operators: storing, publishing, exporting, configuration and the registered queries."""
