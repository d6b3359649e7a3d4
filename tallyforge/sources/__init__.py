"""Reading and writing files, tables and versioned tables."""
