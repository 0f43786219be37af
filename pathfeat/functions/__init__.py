from .stemmer import stem, stems_or_null
from .text import fields, lpad_index, trim_control
from .tokens import is_noun

__all__ = ["stem", "stems_or_null", "fields", "lpad_index", "trim_control", "is_noun"]
