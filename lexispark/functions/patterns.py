"""Character classes shared by the text functions.

Java's ``\\w``, ``\\s`` and ``\\b`` are ASCII by default, so letters of other scripts would be cut apart.
Every pattern is therefore written with explicit Unicode classes.
"""

WORD_CHARS = r"\p{L}\p{N}_"
SPACE_CHARS = r"\s\x0B\x1C-\x1F\x85\p{Z}"

WORD = f"[{WORD_CHARS}]"
NOT_WORD = f"[^{WORD_CHARS}]"
SPACE = f"[{SPACE_CHARS}]"
NOT_SPACE = f"[^{SPACE_CHARS}]"
WORD_START = f"(?<!{WORD})"
WORD_END = f"(?!{WORD})"
