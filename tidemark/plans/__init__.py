"""Published datasets, and the queries over them."""
