"""Column-level helpers (formatting, time arithmetic, bounded ranking)."""
