"""Column-level rules: source types, names, watermark values, generated values."""
