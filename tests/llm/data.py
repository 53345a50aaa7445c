"""Small documents with the awkward cases every operator must take: nulls, empty and long texts, ties, repeats."""

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()),
                       # names that operators use inside
                       T.StructField("rid", T.StringType()), T.StructField("n_words", T.StringType()),
                       T.StructField("kept", T.StringType()), T.StructField("fp", T.StringType()),
                       T.StructField("digest", T.StringType()), T.StructField("words", T.StringType())])


def prose(seed: int, n: int) -> str:
    """n invented words; the same for the same seed."""
    out, x = [], seed * 2654435761 % 2 ** 32 or 1
    for _ in range(n):
        x = (x * 1664525 + 1013904223) % 2 ** 32
        out.append("".join("bcdfghklmnprstv"[(x >> s) % 15] + "aeiou"[(x >> (s + 4)) % 5] for s in (8, 14, 20)))
    return " ".join(out)


def rows():
    base = prose(1, 120)
    texts = [base, base, None, "", "   \n\t ", "one", "One two", base.upper(), base.replace(base.split()[60], "changed"),
             prose(2, 30000), "Zürich naïve Ωμέγα 漢字 words 😀 emoji nbsp", "a  b   c\r\n\x0b d", "<|endoftext|> x <|endoftext|>",
             "no_spaces_" * 3000, prose(3, 80) + "\n" + prose(4, 60), prose(5, 80) + "\n" + prose(4, 60), "tie", "tie"]
    out = [(i, t, ("en", "de", None)[i % 3], ("s0", None)[i % 2], None if t is None else len(t)) for i, t in enumerate(texts)]
    out += [out[0], out[0], (None, base, None, None, 1), (None, None, None, None, None)]
    return [(*r, *["x"] * 6) for r in out]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def raw(text) -> bytes:
    return (text or "").encode()
