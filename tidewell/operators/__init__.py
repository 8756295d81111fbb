"""What a load does with rows: the layout of data files, and the two table formats."""
