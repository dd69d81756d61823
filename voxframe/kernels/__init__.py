"""Pure numpy kernels, run inside Arrow-batched functions."""
