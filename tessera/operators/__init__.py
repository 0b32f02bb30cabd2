"""DataFrame -> DataFrame operators: columns (P), clean (C), encode (E),
sampling (U, M), stats (A), ranking (W), evaluate (V), ensemble (N), and the
distributed primitives in ``order`` and ``quantiles``."""
