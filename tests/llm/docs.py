"""Small tables with everything the operators must stand."""

from pyspark.sql import types as T

CLASHING = "score label key words h n fp root items place line block row id a b name size body text_hash first n_lines _row".split()
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in CLASHING])

PASSAGE = " ".join(f"word{i}" for i in range(20))
TEXTS = [
    "", None, " \n\t ", "One two three.", "One two three.", "one TWO three!", "Ünïcode straße ΟΔΟΣ Σ é é \x1c 日本語 🙂",
    f"before {PASSAGE} after", PASSAGE.upper(), "Released under the MIT License.\nand more", "released under the license by mit",
    "general public license general public license", "a<|endoftext|>b", "it's don't 'S ''ll 12345", "x" * 300,
    "same same same same", "The cat sat on the mat.\nThe dog lay on the rug.\n\nThe cat sat on the mat.", "the", "the the",
    " ".join(f"long{i % 977} text{i % 13}" for i in range(40_000)),
]


def rows():
    """(doc_id, text, lang, source): the texts, some again with other ids, repeated rows and null ids."""
    out = [(i, t, "en" if i % 3 else None, f"s{i % 4}") for i, t in enumerate(TEXTS)]
    out += [(100 + i, t, "de", None) for i, t in enumerate(TEXTS) if i % 4 == 0]
    out += [(3, "One two three.", "en", "s3"), (3, "One two three.", "en", "s3"), (None, "One two three.", "en", "s9"),
            (None, "without an id", None, "s9"), (None, "without an id", None, "s9"), (7, "another text of id seven", "en", "s1")]
    return out


def frame(spark, given=None):
    data = [(i, t, lang, s, len(t or "")) + tuple("x" for _ in CLASHING) for i, t, lang, s in (rows() if given is None else given)]
    return spark.createDataFrame(data, SCHEMA)
