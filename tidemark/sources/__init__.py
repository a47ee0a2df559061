"""Reading typed tables and publishing results."""
