"""Change events applied to documents."""
