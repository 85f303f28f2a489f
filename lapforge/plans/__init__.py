"""Table builds (silver, staging, marts) and the analyses on top of them."""
