"""Relations of the warehouse, as DataFrame -> DataFrame functions."""
