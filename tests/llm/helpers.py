"""Small tables with the awkward cases: null, empty and long texts, repeated rows, clashing names."""

SCHEMA = "doc_id long, text string, lang string, n_chars long, kind string, path string, key string, token string, score double, place int, start int, rank int, component long, size int"
#: Names that operators use inside.
CLASH = ("x", 1, "x", "x", "x", "x", 0.5, 1, 1, 1, 7, 1)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, *CLASH) for i, t in rows], SCHEMA)


def prose(seed, n):
    words, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        words.append("".join("abcdefghijklmnopqrstuvwxyz"[(x >> s) % 26] for s in (3, 8, 13, 18)[: 2 + x % 3]))
    return " ".join(words)


def awkward(spark):
    long = prose(1, 6000)
    return docs(spark, [(1, None), (2, ""), (3, "  \t\n"), (4, long), (5, long), (6, prose(2, 120)), (6, prose(2, 120)), (7, "é漢 ß"), (8, "one two"), (9, "One  TWO"), (None, "lost words here"), (10, "a " * 300)])
