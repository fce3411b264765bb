"""Files and databases as frames."""
