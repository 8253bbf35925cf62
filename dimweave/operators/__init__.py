"""DataFrame to DataFrame steps a load is put together from."""
