"""Documents with everything that may occur, and a table without rows."""

LONG = "word " * 30_000 + "x" * 60_000

TEXTS = [
    "The cat sat on the mat and looked at the dog in the garden. " * 3,
    "The cat sat on the mat and looked at the dog in the garden. " * 3,
    "The  cat sat on\nthe mat and looked at the dog in the garden. " * 3,
    "Der Hund und die Katze sind nicht im Garten, und das ist gut so.",
    None,
    None,
    "",
    "",
    "   \n\t ",
    "123 456 !!!",
    "one",
    "One",
    "one two",
    "日本語のテキスト and some English",
    "<|endoftext|> is a string, is it not? I'll say so; don't you?",
    LONG,
    LONG + " more",
]

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, shard string, slot int, "
    "kept string, keep_id string, group_size string, text_sha256 int, set_id string, signature int, component string, "
    "row int, rank int, score string, severity string, in_group string, start string, length string, held_out int"
)


def documents(spark, extra=True):
    """Unique ids, then rows without an id, then a row that is there three times."""
    made = [(i + 1, text, "en" if i % 3 else None, "s") for i, text in enumerate(TEXTS)]
    made += [(None, "nobody's text stands here", None, None), (None, TEXTS[0], "en", None), (None, None, None, None)]
    made += [(100, "here three times, word for word", "en", "s")] * 3
    rest = (7, "a", 1, "b", "c", "d", 5, "e", 6, "f", 1, 2, "g", "h", "i", "j", "k", 3)
    df = spark.createDataFrame([(*row, *rest) for row in made], SCHEMA)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


def empty(spark):
    return documents(spark).where("false")
