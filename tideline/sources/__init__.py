"""Reading lines, records as text, and writing results."""
