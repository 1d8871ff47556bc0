"""Named compositions of operators: analytic recipes (M1-M25) and the
batch trip-planning model (P1-P19)."""
