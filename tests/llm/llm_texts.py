"""Texts with every odd case."""

LONG = " ".join(f"word{i % 977} and, then. Some more" for i in range(9000))
TEXTS = [
    (0, "Hello <|endoftext|> world  two spaces\n new 123's line. \tÉté naïve 日本 😀"),
    (1, None),
    (2, ""),
    (3, LONG),
    (4, LONG + " the end"),
    (5, "x" * 30_000),
    (6, "!!! ... 42 ??"),
    (7, "the same text in two rows, the very same text"),
    (7, "the same text in two rows, the very same text"),
    (8, "the same text in two rows, the very same text"),
    (None, "a row that has no id at all"),
    (None, None),
    (11, "A İstanbul ΣΣ é tail\r\n\n\n"),
    (12, "one two three four"),
    (13, "One TWO three four"),
    (14, " \n\t "),
    (15, "line one\n\nline two\nline two\n"),
]
