"""Texts every operator has to take."""

AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog. It's a dog's life, isn't it?"),
    (2, None),
    (3, ""),
    (None, "a text without an id, of a few words more"),
    (5, "   \n\t  "),
    (6, "The quick brown fox jumps over the lazy dog. It's a dog's life, isn't it?"),
    (6, "The quick brown fox jumps over the lazy dog. It's a dog's life, isn't it?"),
    (7, "Été à la plage 漢字 \U0001f600 <|endoftext|> 12 345 x\u0000y \U000105c0"),
    (8, "word " * 30_000),
]
