"""Export of results as datasets or single files."""
