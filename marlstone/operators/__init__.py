"""DataFrame operators: lazy, with no driver-side collection of data."""
