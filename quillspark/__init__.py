"""quillspark: Spark jobs that turn personal-data exports into a clean chunk table."""

__version__ = "0.1.0"
