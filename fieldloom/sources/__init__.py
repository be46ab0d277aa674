from .tables import read_table, spread
from .text import read_lines

__all__ = ["read_lines", "read_table", "spread"]
