"""Reading from and writing to files and databases."""
