"""Reading and writing the datasets."""
