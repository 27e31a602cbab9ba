"""Rows that are hard to get right."""


LETTERS = str.maketrans("0123456789", "abcdefghij")


def words(seed, n, stem="w"):
    """A sequence of made-up words that no other seed has."""
    return " ".join(f"{stem}{seed}x{k * k % 97}y{k}" for k in range(n)).translate(LETTERS)


def hard_rows():
    """Nulls, blanks, copies, near copies, a shared passage, a long text and odd white space."""
    base, passage = words(1, 120), words(50, 60)
    near = base.split()
    near[60] = "changed"
    return [
        (1, base, "en", "a", 1),
        (2, " ".join(near), None, "a", None),
        (3, base, "en", None, 3),
        (4, None, None, None, None),
        (5, "", "en", "a", 0),
        (6, " \t\n ", "en", "a", 3),
        (7, "one two", "en", "a", 7),
        (8, "one two", "en", "a", 7),
        (9, words(9, 40) + " " + passage + " " + words(10, 30), "en", "b", 5),
        (10, words(11, 25) + " " + passage + " " + words(12, 35), "en", "b", 5),
        (11, words(13, 30000), "en", "b", 5),
        (None, words(14, 30), "en", "b", 5),
        (None, None, None, None, None),
        (12, words(15, 20) + "\n" + words(16, 12) + "\n" + words(17, 9), "en", "c", 5),
        (13, words(18, 20) + "\n" + words(16, 12) + "\n" + words(19, 9), "en", "c", 5),
        (14, "Под МИР \x1c\x85 ÀÉ İß \U0001f600 á <|endoftext|> don't 's", "xx", "c", 5),
        (14, "Под МИР \x1c\x85 ÀÉ İß \U0001f600 á <|endoftext|> don't 's", "xx", "c", 5),
    ]
