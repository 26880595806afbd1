"""Outputs: files, stamped tables, keyed tables, relational stores and delivery."""
