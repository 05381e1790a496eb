"""Column-level helpers (cleaning, dates, labels) and driver-side distribution tails."""
