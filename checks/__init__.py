"""Binds the library to the star-schema test tables, with an independent SQL for each query."""
