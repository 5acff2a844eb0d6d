import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Rows of `documents` from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(*rows):
        full = [(row[0], row[1], *(row[2:] or ("en", "src1")), len(row[1]) if row[1] else None) for row in rows]
        return spark.createDataFrame(full, COLUMNS)

    return make


LONG = " ".join(f"word{i % 997} tail" for i in range(60_000))

#: Null ids and texts, empty, blank and very long texts, repeated rows and ids, nulls in the other columns.
ODD = [
    (1, "the cat sat on the mat and looked at the dog that slept by the door", "en", "src1"),
    (1, "the cat sat on the mat and looked at the dog that slept by the door", "en", "src1"),
    (2, "der hund schläft auf der straße und die katze schaut über die mauer", "de", None),
    (2, "another text under the same number, which is allowed", None, "src2"),
    (3, None, "en", "src1"), (4, "", None, None), (5, " \n\t ", "en", "src3"), (6, "... !!! ###", "de", "src1"),
    (None, "a text without a number but with words", "en", "src1"), (None, None, None, None),
    (7, LONG, "en", "src1"), (8, "x" * 200_000, "en", "src1"), (9, "nul \x00 byte and   odd blanks   日本語", "en", "src2"),
]


@pytest.fixture
def odd(documents):
    return documents(*ODD)


@pytest.fixture
def clashing(odd):
    """The same with columns named like results and like names used inside."""
    names = ["score", "kept", "shard", "size", "slot", "n_words", "n_hit", "items", "spans", "row", "id", "class_id", "leader", "topic",
             "weight", "n_tokens", "rejected", "lang_pred", "base", "rule", "words", "chunk"]
    names = [name.title() if i % 2 else name for i, name in enumerate(names)]  # a clash need not be in the same case
    names += [f"__{name}" for name in ("text", "tokens", "row", "topic", "draw", "s", "words", "trim", "block", "file", "old", "value", "hot", "of", "n", "new")]
    return odd.withColumns({name: F.lit(f"own {name}") for name in names})
