"""Writers: exports, page archive, dead letters and the tender store."""
