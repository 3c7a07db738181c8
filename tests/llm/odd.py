"""Small tables with everything that may go wrong in them."""

SF_SMALL = "/root/testdata/sf0.001"

# Extra columns whose names the operators use inside.
COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, t string, size bigint, "
           "score double, node bigint, key binary, part int, bucket int, place string, no bigint, draws string")
EXTRA = (7, "t", 3, 0.5, 1, b"k", 2, 1, "p", 9, "d")


def doc(doc_id, text, source="s", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text), *EXTRA)


LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(40000))
PROSE = ("The quick brown fox jumps over the lazy dog while seven wizards quietly brew a potion and the old clock "
         "strikes twelve above the market square, where nobody has slept since the harvest moon came up again.")


def odd_rows():
    near = PROSE.replace("wizards", "witches")
    return [doc(None, None, None, None), doc(None, PROSE, None), doc(1, None), doc(2, ""), doc(3, "  \n\t "), doc(4, "one"),
            doc(5, "one"), doc(6, "One two"), doc(7, PROSE), doc(8, PROSE, "z"), doc(8, PROSE, "z"), doc(8, PROSE, "z"),
            doc(9, near), doc(10, LONG, "long"), doc(11, LONG + " tail", "long"), doc(-12, "é ü 日本語   x y", "é"),
            doc(13, "aaa " * 500), doc(14, PROSE[::-1], ""), doc(15, "\x1c<|endoftext|> 'S don't", "a")]


def odd_documents(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, COLUMNS).repartition(3)
