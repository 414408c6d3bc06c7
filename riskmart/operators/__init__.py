"""DataFrame -> DataFrame steps; none reads or writes storage."""
