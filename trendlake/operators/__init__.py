"""DataFrame to DataFrame operators, to be chained with ``transform``."""
