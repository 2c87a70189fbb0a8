"""DataFrame -> DataFrame operators: flatten, statistics, reports, live state."""
