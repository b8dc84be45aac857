"""How rows are placed: size checks, hot keys and ordered scans."""
