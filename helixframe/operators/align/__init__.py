"""Alignment: kernels on single reads or batches, and the distributed mapper built of them."""
