from .columns import (ceil_div, format_bytes, int_div, last_element, range_header, same_path)

__all__ = ["ceil_div", "format_bytes", "int_div", "last_element", "range_header", "same_path"]
