"""Building blocks of the reports: per-key roll-ups and group maxima."""
