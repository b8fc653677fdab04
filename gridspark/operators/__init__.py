"""DataFrame-to-DataFrame operators over tables and series."""
