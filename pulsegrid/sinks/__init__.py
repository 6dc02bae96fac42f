"""Writers for delimited files, routed output, audited loads and state tables."""
