"""Rows that every operator has to stand: nulls, empty and long texts, ties, repeats, clashing extra columns."""

LONG = "word " * 4000 + "end 0123456789abcdef0123 " + "x" * 20000
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again until the evening comes."),
    (2, None), (3, ""), (4, " \t\n"), (None, "A text without an id, which is null here."), (None, None),
    (5, LONG), (6, "same text in two rows of one id"), (6, "same text in two rows of one id"), (7, "same text in two rows of one id"),
    (8, "ünï çödé 漢字 😀 text \x1c with \x85 odd \xa0 spaces"), (9, "<|endoftext|> </s> [INST] \\ud800 \\"),
]
SCHEMA = "doc_id long, text string, n_words int, fp string, digest int, label string, rules string, size int, key int"


def documents(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, 0, "x", 0, "y", "z", 0, 0) for i, t in rows], SCHEMA).repartition(3)
