"""Reading and writing files, keyed tables and catalog tables."""
