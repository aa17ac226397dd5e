"""Sources: captured pages, bulk extracts, JSON records and paged services; and where results go."""
