import random
import string

from tastemap.functions.text import clean_text

BLANK = set(string.punctuation + string.digits)


def cleaned_by_hand(text, collapse=True):
    """Character by character, from Python's own idea of whitespace."""
    out = []
    for ch in text:
        if collapse:
            blank = ch in BLANK or ch.isspace()
            if not (blank and out and out[-1] == " "):
                out.append(" " if blank else ch)
        else:
            out.append(" " if ch in BLANK or ch in "\r\t\n" else ch)
    return "".join(out)


def clean(spark, texts, collapse=True):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", clean_text("t", collapse).alias("c")).collect()
    return [r["c"] for r in sorted(rows)]


def test_known_texts(spark):
    texts = ["...Don't go!!", "", "10/10", None]
    assert clean(spark, texts) == [" Don t go ", "", " ", None]
    assert clean(spark, texts, collapse=False) == ["   Don t go  ", "", "     ", None]


def test_every_code_point(spark):
    points = [c for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF] + [0x1F600, 0x10FFFF]
    texts = [f"a{chr(c)}b" for c in points]
    for collapse in (True, False):
        got = clean(spark, texts, collapse)
        assert got == [cleaned_by_hand(t, collapse) for t in texts]


def test_random_texts_and_cleaning_twice(spark):
    rng = random.Random(7)
    alphabet = "abcXYZ é漢😀.,!09 \t\n\r\x0b\x1c\x85\xa0  　 -_[]^\\`~"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(2000)]
    once = clean(spark, texts)
    assert once == [cleaned_by_hand(t) for t in texts]
    assert clean(spark, once) == once
    assert clean(spark, texts, False) == [cleaned_by_hand(t, False) for t in texts]
