"""DataFrame operators of the data model."""
