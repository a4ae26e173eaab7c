"""Reading tables, documents and time ranges."""
