"""DataFrame -> DataFrame operators, one module per family of the inventory (C, V, K, TR, I, H, F, R)."""
