import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Awkward documents: nulls, empty and wordless texts, repeats, copies, near copies, odd white space, one long text."""
    base = [f"w{i}" for i in range(80)]
    near = base[:40] + ["other"] + base[41:]
    line = "the quick brown fox jumps over the lazy dog near the river bank at noon today"
    texts = [
        None, "", " \t\n", "one", "one two", " ".join(base), " ".join(base), " ".join(near), "\n".join([line, "Second line here", line]),
        line.upper() + "!", line.replace("noon", "moon") + "\nown words only in this text", "a b c " * 40, "Ünïcode  ﬁgure\x0bx\x85y z　q <|endoftext|> 12345 don't",
        "### *** $$$ &&& <|> %%%", " ".join(f"t{i * i % 977}" for i in range(3000)), "x" * 5000,
    ]
    rows = [(i, t, ("en", "de", None)[i % 3], ("b", "a", None, "c")[i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[5], (None, " ".join(base[:60]), "en", "a", 1), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def empty(documents):
    return documents.where("false")
