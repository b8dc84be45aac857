"""Reading the given tables and writing layouts that later scans can skip in."""
