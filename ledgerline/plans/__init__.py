"""Job-level plans: size-checked broadcasts and end-to-end runs."""
