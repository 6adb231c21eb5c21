"""Rows that every operator must stand: nulls, empty and long texts, ties,
repeated rows, and extra columns whose names operators use themselves."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard int, part int, kept string, taken int, body string, score string, rep int, n int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) & 0x7FFFFFFF
        out.append(WORDS[(x >> 16) % len(WORDS)] + "aeiou"[(x >> 8) % 5] + str(x >> 4 & 7) * (x >> 12 & 1))
    return " ".join(out)


def rows() -> list[tuple]:
    long = prose(5, 30_000)
    texts = [
        (1, prose(1, 80), "en", "a"), (2, prose(1, 80), "en", "b"), (3, prose(2, 200), "en", "a"), (4, None, "en", "a"), (5, "", None, None), (6, "   \n\t ", "fr", "b"),
        (7, "one", "fr", None), (8, "ONE", "fr", "c"), (9, long, "en", "a"), (10, long + " more", "en", "a"), (11, "日本語 ünï 😀  x y", "de", "c"), (None, prose(3, 50), "en", "a"),
        (12, "12345 !!!", "de", "b"), (13, prose(4, 40), None, "d"), (13, prose(4, 40), None, "d"), (14, "a  b \n c", "de", "d"), (15, "end <|endoftext|> of", "en", "a"),
    ]
    return [(i, t, la, s, len(t or ""), 1, 2, 3, "x", 4, "y", "z", 5, 6) for i, t, la, s in texts]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def text_bytes(t: str | None) -> bytes:
    return (t or "").encode()


def words(t: str | None) -> list[bytes]:
    """Lower-cased words, independent of the library."""
    import re

    lowered = bytes(b + 32 if 65 <= b <= 90 else b for b in text_bytes(t))
    return re.findall(rb"[^\x20\x09-\x0D]+", lowered)
