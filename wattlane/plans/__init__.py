"""Read queries and write jobs put together from the operators."""
