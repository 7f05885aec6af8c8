"""Rows that every operator has to take, and a way to compare."""

LONG = "lorem ipsum dolor sit amet " * 20_000

#: id, text, lang, source: nulls in every column, empty and very long texts, repeated rows.
ODD_ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
    (1, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
    (None, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
    (2, None, "en", "a"),
    (3, "", "en", None),
    (4, " \n\t ", None, "b"),
    (5, LONG, "en", "b"),
    (6, "x", None, None),
    (None, None, None, None),
    (7, "Ünï çødé 中文   😀 <|endoftext|> <|im_end|>", "de", "b"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


def rows(df, *columns):
    """Rows as sorted tuples, by position (names may clash)."""
    names = df.columns
    at = [names.index(c) for c in columns] if columns else range(len(names))
    return sorted((tuple(r[i] for i in at) for r in df.collect()), key=repr)
