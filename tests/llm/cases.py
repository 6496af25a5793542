"""Small awkward tables shared by the tests."""

PROSE = ("the river ran past the old mill and nobody counted the stones that winter because the light was poor "
         "and every wheel stood still until the miller came home with his two sons and a cart of barley").split()


def awkward_docs():
    """(doc_id, text, source): nulls, empty and blank texts, a very long one, ties, copies, repeated rows, odd characters."""
    rows = [(k, f"Shared line\nown line {k}\n  SHARED LINE \t\n\nÉté {k}", "b" if k % 3 else "a") for k in range(30)]
    base = " ".join(PROSE * 3)
    rows += [(100 + k, base + (" tail" if k % 2 else ""), "a") for k in range(12)]
    rows += [(200, None, "a"), (201, "", "b"), (202, " \t\r\n ", None), (203, "one", None), (204, "Two words", ""),
             (205, "\n\n\n", "c"), (206, "Ünïcode ÉCOLE école 　wide nbsp", "c"), (None, "no id here at all", "a"),
             (None, None, None), (207, "x " * 60000 + "\n" + "shared line\n" * 500, "c"), (203, "one", None), (204, "Two words", ""),
             (208, "quote \"a\", b | c \\n literal", "z")]
    return rows


def docs_frame(spark, rows=None):
    """With extra columns whose names clash with the operators' own."""
    rows = awkward_docs() if rows is None else rows
    extra = ("size", "start", "rank", "text_hash", "fp", "pos", "n", "key", "block", "line", "dropped", "features", "words", "hits", "bag")
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{x}` string" for x in extra)
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *["x"] * len(extra)) for i, t, s in rows], schema)


def empty_docs(spark):
    return docs_frame(spark, [])
