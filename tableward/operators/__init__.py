"""DataFrame operators: quality assessment, cleaning, exploration, status."""
