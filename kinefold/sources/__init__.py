"""Reading and writing of trajectory datasets."""
