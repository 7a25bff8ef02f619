import pytest

#: Columns that clash with names the operators use inside.
CLASHING = ("id", "key", "fp", "head", "component", "tie", "shard", "block", "digest", "words", "row", "n", "range", "blob", "label", "x")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


@pytest.fixture(scope="session")
def table(spark):
    """Documents of ``(doc_id, text)`` pairs, with the other columns and clashing ones."""

    def made(pairs, parts=3):
        rows = [(k, t, None, "s", None if t is None else len(t), *["z"] * len(CLASHING)) for k, t in pairs]
        df = spark.createDataFrame(rows, DOCUMENTS)
        return df.repartition(parts) if rows else df

    return made


PROSE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen".split()


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, a null key, repeated rows, ties, a long text, characters beyond the first plane."""
    long = " ".join(f"word{i % 977}x{i // 50}" for i in range(30_000))
    return [
        (1, "plain words in a line\nand a second line"),
        (2, None),
        (3, ""),
        (4, "   \t\n "),
        (5, long),
        (6, "naïve café 𝒳𝒴 ünïcode — 你好 世界 end"),
        (7, "plain words in a line\nand a second line"),
        (7, "plain words in a line\nand a second line"),
        (7, "another text of the same key"),
        (None, "a text without a key"),
        (None, None),
    ]


def pairs(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]
