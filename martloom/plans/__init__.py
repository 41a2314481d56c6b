"""What the layers compute, as DataFrame builders, and the job that writes them."""
