from lodestar.functions.pricing import discounted, register_functions
from lodestar.functions.text import joined_name, part_at

__all__ = ["discounted", "joined_name", "part_at", "register_functions"]
