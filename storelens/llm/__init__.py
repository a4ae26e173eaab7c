"""Operators that turn raw documents into training data; nothing else in the library imports them."""
